"""A run's tables replace the earlier ones together, or none does."""
import os

import pytest

from milepost.plans.layout import Layout
from milepost.sources import publish, sinks

TABLES = (("eda", "counts"), ("final_metrics", "nested/metrics"), ("data", "snapshots"))


def _write(spark, root, run, tables=TABLES):
    staged = publish.stage(root)
    for folder, name in tables:
        sinks.write_table(spark.range(3).selectExpr("id", f"{run} as run"), staged.path(folder, name))
    return staged


def _runs(spark, root):
    return [sorted({r.run for r in spark.read.parquet(Layout(root).path(*t)).collect()}) for t in TABLES]


def _leavings(root):
    return [n for n in os.listdir(root) if n.startswith("_")]


def test_all_tables_are_replaced_and_other_files_stay(spark, tmp_path):
    root = str(tmp_path)
    publish.publish(spark, _write(spark, root, 1))
    other = tmp_path / "outputs" / "03_eda" / "notes.txt"
    other.write_text("keep me")
    paths = publish.publish(spark, _write(spark, root, 2))
    assert _runs(spark, root) == [[2]] * 3 and other.read_text() == "keep me" and _leavings(root) == []
    assert sorted(paths) == sorted(Layout(root).path(*t) for t in TABLES)


def test_stopped_before_the_decision_nothing_changes(spark, tmp_path):
    root = str(tmp_path)
    publish.publish(spark, _write(spark, root, 1))
    _write(spark, root, 2, TABLES[:2])  # the run ends here
    assert _runs(spark, root) == [[1]] * 3 and publish.is_settled(spark, root)
    publish.recover(spark, root)
    assert _runs(spark, root) == [[1]] * 3 and _leavings(root) == []


@pytest.mark.parametrize("moved", [0, 1, 3])
def test_stopped_after_the_decision_the_next_run_completes_it(spark, tmp_path, moved):
    root = str(tmp_path)
    publish.publish(spark, _write(spark, root, 1))
    staged = _write(spark, root, 2)
    publish.decide(spark, staged)
    for folder, name in TABLES[:moved]:  # the run ends after so many moves
        target = Layout(root).path(folder, name)
        os.rename(target, str(tmp_path / f"old{name.replace('/', '-')}"))
        os.rename(staged.path(folder, name), target)
    assert not publish.is_settled(spark, root)
    publish.recover(spark, root)
    assert _runs(spark, root) == [[2]] * 3 and publish.is_settled(spark, root) and _leavings(root) == []


def test_a_table_that_was_not_written_stops_the_decision(spark, tmp_path):
    root = str(tmp_path)
    publish.publish(spark, _write(spark, root, 1))
    staged = _write(spark, root, 2)
    staged.path("eda", "forgotten")
    with pytest.raises(OSError, match="forgotten"):
        publish.publish(spark, staged)
    assert _runs(spark, root) == [[1]] * 3


def test_nothing_to_recover(spark, tmp_path):
    publish.recover(spark, str(tmp_path / "absent"))
    assert publish.is_settled(spark, str(tmp_path / "absent"))


def test_the_job_publishes_all_its_tables_at_once(spark, small, tmp_path, monkeypatch):
    """The job's own sequence, with given predictions in place of the model fits."""
    from types import SimpleNamespace

    from milepost.config import Config
    from milepost.operators import evaluate as EV
    from milepost.plans import pipeline
    from milepost.plans import queries as Q
    rows = Q._scored_rows(small).withColumns({
        "predicted_customs_deviation_hours": Q.F.col("direct"), "predicted_post_customs_deviation_hours": Q.F.col("structured"),
        "predicted_inland_deviation_hours": Q.F.col("structured"),
        "predicted_final_delay_hours": Q.F.col("b2_predicted_delay_hours"),
        "predicted_final_eta": Q.ET.predicted_eta("b2_predicted_delay_hours"), "risk_raw_probability": Q.F.lit(0.5),
        "risk_level": Q.RK.risk_level(), "predicted_material_delay": Q.RK.risk_alert()})
    rows = pipeline.cut_lineage(Q.ET.s3_targets(Q.ET.s2_targets(rows)))
    model = SimpleNamespace(direct=0, customs=0, post_customs=0, inland=0, classifier=0, platt=0)
    scored = pipeline.PassResult(rows, EV.regression_metrics(rows, Q._ALL_METHODS), EV.risk_metrics(rows),
                                 EV.calibration_table(rows), model, model, SimpleNamespace(remove=lambda: None))
    monkeypatch.setattr(pipeline, "evaluate_pass", lambda *a, **k: scored)
    monkeypatch.setattr(pipeline, "eda_tables", lambda t: {"counts": spark.range(1)})
    monkeypatch.setattr(sinks, "save_fitted", lambda s, m, path: sinks.write_table(s.range(1), path))
    monkeypatch.setattr(sinks, "save_model", lambda m, path: sinks.write_table(spark.range(1), path))
    root = str(tmp_path)
    summary = pipeline.run(spark, "/root/testdata/sf0.001", root, Config(), tables=small, checkpoint=False)
    assert _leavings(root) == [] and publish.is_settled(spark, root)
    assert spark.read.parquet(Layout(root).path("final_metrics", "final_test_model_comparison")).count() == 23
    assert spark.read.parquet(Layout(root).path("final_predictions", "final_test_risk_predictions")).count() == summary["test_snapshots"]
    assert summary["report_paths"]["cases"] == Layout(root).path("final_reports", "final_case_studies")
    assert os.path.isdir(Layout(root).path("artifacts", "eta_v2/direct"))
    assert os.path.isdir(os.path.join(Layout(root).data("snapshots"), "snapshot_stage=PORT_ARRIVED"))
