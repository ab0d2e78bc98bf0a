"""M3 contract: outputs exist, unrelated files kept, summary keys, quotas."""
import glob
import os
import tempfile

from milepost.plans import pipeline

SUMMARY_KEYS = {"policy", "seed", "split_shipments", "test_snapshots", "test_snapshots_by_stage",
                "risk_threshold", "no_post_test_tuning", "eta_mae_hours", "eta_rmse_hours",
                "risk_pr_auc", "risk_brier_score", "risk_f1", "report_paths"}


def test_end_to_end(spark, tiny_cfg):
    root = tempfile.mkdtemp(prefix="milepost-e2e-")
    keep = os.path.join(root, "outputs", "unrelated.txt")
    os.makedirs(os.path.dirname(keep), exist_ok=True)
    with open(keep, "w") as fh:
        fh.write("keep me")
    summary = pipeline.run(spark, "/root/testdata/sf0.001", root, tiny_cfg)
    assert SUMMARY_KEYS <= set(summary)
    assert open(keep).read() == "keep me"
    n = sum(summary["split_shipments"].values())
    assert summary["split_shipments"] == {"train": n * 175 // 250, "validation": n * 37 // 250,
                                          "test": n - n * 175 // 250 - n * 37 // 250}
    assert summary["test_snapshots"] == sum(summary["test_snapshots_by_stage"].values())
    for part in ("outputs/01_data_quality/quality_report", "outputs/02_split/split_manifest",
                 "outputs/03_eda/delay_buckets", "outputs/04_model_validation/baselines/baseline_metrics_validation",
                 "outputs/04_model_validation/risk/risk_validation_metrics",
                 "outputs/05_final_evaluation/metrics/final_test_model_comparison",
                 "outputs/05_final_evaluation/metrics/final_test_risk_calibration",
                 "outputs/05_final_evaluation/predictions/final_test_risk_predictions",
                 "outputs/05_final_evaluation/reports/final_case_studies",
                 "outputs/05_final_evaluation/reports/final_test_summary",
                 "outputs/05_final_evaluation/artifacts/platt_calibrator",
                 "outputs/05_final_evaluation/artifacts/eta_v2/direct/model",
                 "data/snapshots/snapshot_stage=PORT_ARRIVED"):
        assert glob.glob(os.path.join(root, part, "*")), part
    cal = spark.read.parquet(os.path.join(root, "outputs/05_final_evaluation/metrics/final_test_risk_calibration"))
    assert sum(r.n for r in cal.collect()) == summary["test_snapshots"]
    risk = spark.read.parquet(os.path.join(root, "outputs/05_final_evaluation/predictions/final_test_risk_predictions"))
    assert risk.where("predicted_material_delay <> (risk_probability >= 0.29)").count() == 0
    comp = spark.read.parquet(os.path.join(root, "outputs/05_final_evaluation/metrics/final_test_model_comparison"))
    assert comp.count() == 23
