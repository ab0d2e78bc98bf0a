"""Evaluation formulas and boundaries on hand-made cases."""
import bisect
import random

import pytest

from milepost.operators import evaluate as EV
from milepost.operators import risk as RK


def _scores(spark, rows):
    return spark.createDataFrame(rows, "snapshot_stage string, risk_probability double, target_is_materially_delayed int")


def test_average_precision_ties_one_step(spark):
    df = _scores(spark, [("ORIGIN_DEPARTED", 0.9, 1), ("ORIGIN_DEPARTED", 0.5, 1),
                         ("ORIGIN_DEPARTED", 0.5, 0), ("ORIGIN_DEPARTED", 0.1, 0)])
    ap = {r.scope: r.pr_auc for r in EV.average_precision(df).collect()}
    assert abs(ap["ALL"] - (0.5 * 1.0 + 0.5 * (2 / 3))) < 1e-12


def test_no_positive_predictions_precision_zero(spark):
    df = _scores(spark, [("PORT_ARRIVED", 0.1, 1), ("PORT_ARRIVED", 0.2, 0)])
    r = {x.scope: x for x in EV.precision_recall_f1(df).collect()}["ALL"]
    assert (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0)


def test_calibration_edges_and_empty_bins(spark):
    df = _scores(spark, [("ORIGIN_DEPARTED", 0.0, 0), ("ORIGIN_DEPARTED", 0.2, 0),
                         ("ORIGIN_DEPARTED", 0.6, 1), ("ORIGIN_DEPARTED", 1.0, 1)])
    got = [(r.bin, r.n) for r in EV.calibration_table(df).collect()]
    assert got == [("(-0.001, 0.2]", 2), ("(0.2, 0.4]", 0), ("(0.4, 0.6]", 1), ("(0.6, 0.8]", 0), ("(0.8, 1.0]", 1)]


def test_risk_level_and_alert_boundaries(spark):
    df = spark.createDataFrame([(0.29,), (0.35,), (0.65,), (None,), (1.2,)], "risk_probability double")
    got = [(r.l, r.a) for r in df.select(RK.risk_level().alias("l"), RK.risk_alert().alias("a")).collect()]
    assert got == [("LOW", True), ("LOW", True), ("MEDIUM", True), (None, False), (None, True)]


def test_regression_metrics_omits_empty_scopes(spark):
    df = spark.createDataFrame([("ORIGIN_DEPARTED", 10.0, 0.0, None), ("PORT_ARRIVED", 12.0, 0.0, 11.0)],
                               "snapshot_stage string, target_final_delay_hours double, b0 double, s double")
    m = EV.regression_metrics(df, {"B0 Scheduled ETA": "b0", "Structured HGB v2": "s"})
    rows = [(r.method, r.scope, r.n_snapshots) for r in m.collect()]
    assert rows == [("B0 Scheduled ETA", "ALL", 2), ("B0 Scheduled ETA", "ORIGIN_DEPARTED", 1),
                    ("B0 Scheduled ETA", "PORT_ARRIVED", 1), ("Structured HGB v2", "ALL", 1),
                    ("Structured HGB v2", "PORT_ARRIVED", 1)]
    assert abs(m.where("scope = 'ALL' AND method = 'B0 Scheduled ETA'").first().rmse_hours
               - ((100 + 144) / 2) ** 0.5) < 1e-12


def _brute_ap(rows):
    rows = sorted(rows, key=lambda r: -r[1])
    positives, tp, seen, total, i = sum(r[2] for r in rows), 0, 0, 0.0, 0
    while i < len(rows):
        tied = [r for r in rows[i:] if r[1] == rows[i][1]]
        gained = sum(r[2] for r in tied)
        tp, seen, i = tp + gained, seen + len(tied), i + len(tied)
        total += gained * tp / seen
    return total / positives if positives else None


@pytest.mark.parametrize("ranges", [1, 7, 4096])
def test_average_precision_equals_brute_force_on_clustered_scores(spark, ranges):
    rng = random.Random(5)
    rows = [(stage, rng.choice([0.5 + rng.randrange(300) * 1e-9, rng.random(), 0.25, 1.0]), int(rng.random() < 0.3))
            for stage in ("ORIGIN_DEPARTED", "PORT_ARRIVED") for _ in range(600)]
    rows += [("CUSTOMS_CLEARED", 0.4, 0), ("CUSTOMS_CLEARED", None, 1)]
    ap = {r.scope: r.pr_auc for r in EV.average_precision(_scores(spark, rows), ranges=ranges).collect()}
    scored = [r for r in rows if r[1] is not None]
    for scope in ("ALL", "ORIGIN_DEPARTED", "PORT_ARRIVED"):
        want = _brute_ap([r for r in scored if scope in ("ALL", r[0])])
        assert abs(ap[scope] - want) < 1e-9, scope
    assert ap["CUSTOMS_CLEARED"] is None


def test_average_precision_runs_no_job_before_an_action(spark):
    df = _scores(spark, [("PORT_ARRIVED", i / 500, int(i % 3 == 0)) for i in range(500)])
    sc = spark.sparkContext
    sc.setJobGroup("planning", "plan only")
    try:
        planned = EV.average_precision(df)
        planned.explain()
        assert sc.statusTracker().getJobIdsForGroup("planning") == []
        planned.collect()
        assert sc.statusTracker().getJobIdsForGroup("planning")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_clustered_scores_spread_over_ranges(spark):
    df = _scores(spark, [("PORT_ARRIVED", 0.5 + i * 1e-12, 0) for i in range(20_000)] + [("PORT_ARRIVED", 1e12, 1)])
    scores = EV.score_counts(df, "risk_probability", "target_is_materially_delayed")
    edges = EV._score_edges(scores, 256).first()._edges
    inside = [0] * (len(edges) + 1)
    for r in scores.collect():
        inside[bisect.bisect_left(edges, r._p)] += 1
    assert len(edges) == 256 and max(inside) < 20_000 * 12 / 256


def test_average_precision_without_scores(spark):
    assert EV.average_precision(_scores(spark, [])).collect() == []
    only_missing = EV.average_precision(_scores(spark, [("PORT_ARRIVED", None, 1)])).collect()
    assert only_missing == []
