"""M1-M3: the end-to-end job.

One Spark application: tables in, tables out.  Each pass cuts lineage of its
inputs and of its scored predictions with reliable checkpoints (shared
``spark.checkpoint.dir``), so a lost executor recomputes one stage, not the
whole cross-fitting history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.config import METHODS, RISK_THRESHOLD, Config
from milepost.operators import baselines as BL
from milepost.operators import evaluate as EV
from milepost.operators import profile as PR
from milepost.operators import quality as QA
from milepost.operators import report as RP
from milepost.operators.crossfit import FoldStore, run_tag
from milepost.operators.eta import EtaModels, fit_eta
from milepost.operators.risk import RiskModels, fit_risk_stack
from milepost.plans.catalog import Journeys, load, load_tables
from milepost.plans.layout import Layout
from milepost.session import cut_lineage
from milepost.sources import publish, sinks
from milepost.sources.testdata import expected_journeys

PREDICTION_COLUMNS = dict(zip(METHODS, (
    "b0_predicted_delay_hours", "b1_predicted_delay_hours", "b2_predicted_delay_hours",
    "direct_v2_predicted_final_delay_hours", "structured_v2_predicted_final_delay_hours",
    "predicted_final_delay_hours")))
BASELINE_METHODS = METHODS[:3]
ETA_METHODS = METHODS[3:]


@dataclass
class PassResult:
    predictions: DataFrame
    comparison: DataFrame
    risk: DataFrame
    calibration: DataFrame
    eta_models: EtaModels
    risk_models: RiskModels
    store: FoldStore


def evaluate_pass(t: Journeys, fit_splits, predict_split: str, cfg: Config,
                  checkpoint: bool = True, folds_root: str | None = None) -> PassResult:
    """M1 / M2: fit ETA + risk on ``fit_splits``, score ``predict_split``.  Folds that a
    stopped run left under ``folds_root`` are not fitted again."""
    cut = cut_lineage if checkpoint else (lambda d: d)
    fit_rows = cut(t.snapshots_of(*fit_splits))
    fit_ships = cut(t.shipments_of(*fit_splits))
    pred_rows = cut(t.snapshots_of(predict_split))
    store = FoldStore(fit_rows.sparkSession, folds_root, run_tag(cfg, fit_rows))
    eta_models, eta_pred = fit_eta(fit_rows, fit_ships, pred_rows, cfg)
    eta_pred = cut(eta_pred)
    risk_models, pred = fit_risk_stack(fit_rows, fit_ships, pred_rows, eta_pred, cfg,
                                       checkpoint=checkpoint, store=store)
    pred = cut(BL.all_baselines(fit_ships, pred))
    comparison = EV.regression_metrics(pred, PREDICTION_COLUMNS, cfg.stages)
    risk = EV.risk_metrics(pred, threshold=cfg.risk_threshold, stages=cfg.stages)
    calibration = EV.calibration_table(pred)
    return PassResult(pred, comparison, risk, calibration, eta_models, risk_models, store)


def eda_tables(t: Journeys) -> dict:
    sh, ev, sn = t.shipments, t.events, t.snapshots
    return {
        "snapshot_counts_by_stage": PR.snapshot_counts_by_stage(sn, t.cfg.stages),
        "shipments_by_route": PR.counts_by(sh, "route"),
        "shipments_by_carrier": PR.counts_by(sh, "carrier"),
        "planned_duration_by_route": PR.planned_duration_by_route(sh),
        "route_delay": PR.route_delay(sh, t.cfg.material_delay_hours),
        "delay_buckets": PR.delay_buckets(sh),
        "delay_distribution": PR.delay_distribution(sh),
        "propagation": PR.propagation(sh),
        "update_quality": PR.update_quality(ev),
        "feature_availability": PR.feature_availability(sn, t.cfg.stages),
        "mean_delay_by_route": PR.mean_delay_by_route(sh),
        "delay_histogram": PR.delay_histogram(sh),
        "propagation_points": PR.propagation_points(sh),
    }


def _rows(df: DataFrame) -> list[dict]:
    """Small (<= a few dozen rows) metric tables only."""
    return [r.asDict() for r in df.collect()]


def summary_record(cfg: Config, manifest: DataFrame, predictions: DataFrame, comparison: DataFrame,
                   risk: DataFrame, paths: dict) -> dict:
    """The run's one record, from the split, the scored test rows and their metrics."""
    split_sizes = {r["split"]: r["n"] for r in _rows(manifest.groupBy("split").agg(F.count(F.lit(1)).alias("n")))}
    by_stage = {r["snapshot_stage"]: r["n_snapshots"] for r in _rows(EV.counts_by_stage(predictions))}
    head = _rows(EV.headline(comparison, risk))
    head = head[0] if head else {}
    # The keys and the policy text of the original summary.
    return {
        "policy": "Stage-routed v2 ETA plus Risk HGB v2 Stack",
        "seed": cfg.seed,
        "split_shipments": split_sizes,
        "test_snapshots": int(sum(by_stage.values())),
        "test_snapshots_by_stage": by_stage,
        "risk_threshold": cfg.risk_threshold if cfg.risk_threshold is not None else RISK_THRESHOLD,
        "no_post_test_tuning": True,
        "eta_mae_hours": head.get("eta_mae_hours"),
        "eta_rmse_hours": head.get("eta_rmse_hours"),
        "risk_pr_auc": head.get("risk_pr_auc"),
        "risk_brier_score": head.get("risk_brier_score"),
        "risk_f1": head.get("risk_f1"),
        "report_paths": paths,
    }


def write_scored(lay: Layout, predictions: DataFrame, comparison: DataFrame, risk: DataFrame,
                 calibration: DataFrame, fmt: str = "parquet") -> None:
    """A3: metric and prediction tables of the scored test rows."""
    sinks.write_table(comparison, lay.path("final_metrics", "final_test_model_comparison"), fmt, small=True)
    sinks.write_table(risk, lay.path("final_metrics", "final_test_risk_metrics"), fmt, small=True)
    sinks.write_table(calibration, lay.path("final_metrics", "final_test_risk_calibration"), fmt, small=True)
    sinks.write_table(predictions, lay.path("final_predictions", "final_test_predictions"), fmt)
    sinks.write_risk_predictions(predictions, lay.path("final_predictions", "final_test_risk_predictions"), fmt)


def run(spark: SparkSession, sf_dir: str, root: str, cfg: Config | None = None,
        strict: bool = True, fmt: str = "parquet", checkpoint: bool = True,
        tables: Journeys | None = None, expected_shipments: int | None = None,
        folds_root: str | None = None) -> dict:
    """M3: validate -> split -> EDA -> validation pass -> refit pass -> sinks.
    All tables of the run take the place of an earlier run's together, or none does.
    A run that was stopped goes on with the folds it left under ``folds_root``.

    Input: the mapped tables of ``sf_dir``, or ``tables`` (catalog.load_tables), whose
    population is ``expected_shipments`` (unknown: only repeated ids break C1)."""
    cfg = cfg or Config()
    if tables is None and expected_shipments is None:
        expected_shipments = expected_journeys(spark, sf_dir)
    t = tables or load(spark, sf_dir, cfg)
    if checkpoint:
        t = t.materialize()
    publish.recover(spark, root)
    final, lay = Layout(root), publish.stage(root)
    report = QA.quality_report(t.shipments, t.events, t.snapshots, expected_shipments, stages=cfg.stages)
    report_rows = sorted(_rows(report), key=lambda r: r["rule"])  # 13 rows
    refused = strict and any(r["violations"] for r in report_rows)
    sinks.write_table(report.withColumn("sample_ids", F.array_join("sample_ids", ",")),
                      (final if refused else lay).path("quality", "quality_report"), fmt, small=True)
    if refused:  # the report of what was refused is all that such a run replaces
        for r in report_rows:
            if r["violations"]:
                raise ValueError(f"{QA.MESSAGES[r['rule']]} ({r['rule']}: {r['violations']})"
                                 + (f", e.g. {', '.join(r['sample_ids'])}" if r["sample_ids"] else ""))
    sinks.write_base_tables(lay, t.shipments, t.events, t.snapshots, t.manifest, fmt)
    for name, df in eda_tables(t).items():
        sinks.write_table(df, lay.path("eda", name), fmt, small=name != "propagation_points")

    # M1: train-only validation pass
    val = evaluate_pass(t, ("train",), "validation", cfg, checkpoint, folds_root)
    comp = val.comparison
    sinks.write_table(comp.where(F.col("method").isin(list(BASELINE_METHODS))),
                      lay.path("validation", "baselines/baseline_metrics_validation"), fmt, small=True)
    sinks.write_table(comp.where(F.col("method").isin(list(ETA_METHODS))),
                      lay.path("validation", "eta/eta_validation_metrics"), fmt, small=True)
    sinks.write_table(val.predictions, lay.path("validation", "eta/eta_validation_predictions"), fmt)
    sinks.write_table(val.risk, lay.path("validation", "risk/risk_validation_metrics"), fmt, small=True)
    sinks.write_risk_predictions(val.predictions, lay.path("validation", "risk/risk_validation_predictions"), fmt)
    sinks.write_table(RP.report_metrics(comp, RP.ETA_REPORT_METHODS),
                      lay.path("validation", "eta/eta_validation_report_table"), fmt, small=True)
    sinks.write_table(RP.risk_report(val.risk), lay.path("validation", "risk/risk_validation_report_table"),
                      fmt, small=True)

    # M2: refit on train + validation, score test once
    fin = evaluate_pass(t, ("train", "validation"), "test", cfg, checkpoint, folds_root)
    write_scored(lay, fin.predictions, fin.comparison, fin.risk, fin.calibration, fmt)

    # A5: models
    m = fin.eta_models
    for name, fm in (("direct", m.direct), ("customs", m.customs), ("post_customs", m.post_customs),
                     ("inland", m.inland)):
        sinks.save_fitted(spark, fm, lay.path("artifacts", f"eta_v2/{name}"))
    sinks.save_fitted(spark, fin.risk_models.classifier, lay.path("artifacts", "risk_hgb_v2_stack"))
    sinks.save_model(fin.risk_models.platt, lay.path("artifacts", "platt_calibrator"))

    # L1-L9 report tables
    cases = RP.case_rows(fin.predictions, cfg.risk_threshold)
    sinks.write_table(cases, lay.path("final_reports", "final_case_studies"), "json", small=True)
    sinks.write_table(RP.quality_counts(t.shipments, t.events, t.snapshots, report),
                      lay.path("quality", "quality_counts"), fmt, small=True)
    sinks.write_table(RP.risk_by_stage(fin.predictions), lay.path("final_reports", "risk_by_stage"), fmt, small=True)
    sinks.write_table(RP.mae_by_method(fin.comparison), lay.path("final_reports", "mae_by_method"), fmt, small=True)
    sinks.write_table(RP.report_metrics(fin.comparison), lay.path("final_reports", "final_eta_report_table"),
                      fmt, small=True)
    sinks.write_table(RP.risk_report(fin.risk), lay.path("final_reports", "final_risk_report_table"), fmt, small=True)

    # summary
    summary = summary_record(cfg, t.manifest, fin.predictions, fin.comparison, fin.risk, {
        "quality": final.path("quality", "quality_report"),
        "eda": final.path("eda", ""),
        "final": final.path("final_metrics", ""),
        "cases": final.path("final_reports", "final_case_studies"),
    })
    sinks.write_summary(spark, summary, lay.path("final_reports", "final_test_summary"))
    publish.publish(spark, lay)
    for done in (val, fin):
        done.store.remove()
    return summary


def main(argv=None) -> None:
    """Command line: python -m milepost.plans.pipeline --sf-dir DIR --out DIR [--fast]."""
    import argparse
    import json

    from milepost.session import build_session
    ap = argparse.ArgumentParser(description="milestone-journey pipeline")
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--sf-dir", help="folder of the order tables the journeys are mapped from")
    source.add_argument("--tables", help="folder of stored shipments, events and snapshots")
    ap.add_argument("--format", default="parquet", help="of the stored tables")
    ap.add_argument("--expected-shipments", type=int)
    ap.add_argument("--out", required=True)
    ap.add_argument("--fast", action="store_true", help="reduced boosted-tree preset")
    ap.add_argument("--master", default="local[8]")
    ap.add_argument("--folds", help="folder that keeps finished folds, so that a stopped run can go on")
    ap.add_argument("--no-strict", action="store_true", help="report quality rules without raising")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    cfg = Config.fast() if args.fast else Config()
    tables = load_tables(spark, args.tables, args.format, cfg) if args.tables else None
    print(json.dumps(run(spark, args.sf_dir, args.out, cfg, strict=not args.no_strict, tables=tables,
                         expected_shipments=args.expected_shipments, folds_root=args.folds), indent=2, default=str))


if __name__ == "__main__":
    main()
