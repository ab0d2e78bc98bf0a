"""Exact medians, counted lookup joins, and the rules for missing values."""
import random
import statistics

import pytest
from pyspark.sql import functions as F

from milepost.operators import encode, evaluate, features, lookup, quantile, risk
from milepost.functions.time import round_hours_from_micros, micros_between


def _rows(n=3000):
    r = random.Random(5)
    routes = ["hot"] * 9 + ["a", "b", None]  # one route holds three quarters of the rows
    return [(f"s{i}", r.choice(routes), r.choice([None, float("nan"), round(r.gauss(5, 9), 3), 1e9 * r.random(), 2.0]))
            for i in range(n)]


def test_grouped_median_is_exact_under_a_hot_group(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "shipment_id string, route string, v double")
    got = {x.route: x.m for x in quantile.grouped_median(df, ["route"], "v", "m").collect()}
    for route in {x for _, x, _ in rows}:
        own = [v for _, x, v in rows if x == route and v is not None and v == v]
        assert got[route] == statistics.median(own)
    everyone = quantile.grouped_medians(df, [], ["v"]).first().v
    assert everyone == statistics.median([v for _, _, v in rows if v is not None and v == v])
    none = quantile.grouped_medians(df.where("false"), [], ["v"]).collect()
    assert len(none) == 1 and none[0].v is None


@pytest.mark.parametrize("sorted_values", [8, quantile.SORTED])
def test_repeated_splitting_is_exact(spark, monkeypatch, sorted_values):
    monkeypatch.setattr(quantile, "BROADCAST_GROUPS", 2)  # the salted way as well
    r = random.Random(8)
    rows = [(r.choice([None, "a", "b", "c"]), r.choice([10.0 ** r.randint(-300, 300), -r.random(), r.randint(0, 3) * 1.0]))
            for _ in range(4000)] + [("one", 5.0), ("two", 1.0), ("two", 4.0), ("none", None), ("d", float("inf"))]
    df = spark.createDataFrame(rows, "k string, v double")
    counts = quantile.value_counts(df, ["k"], "v")
    got = {x.k: x.m for x in quantile.median_of_counts(counts, ["k"], "m", sorted_values).collect()}
    for k in {k for k, _ in rows}:
        own = sorted(v for g, v in rows if g == k and v is not None)
        assert got[k] == (pytest.approx(statistics.median(own), rel=1e-15) if own else None)


def test_no_task_sorts_a_large_part_of_skewed_values(spark):
    n = 2_000_000
    rows = spark.range(n).select(F.when(F.col("id") == 7, F.lit(1e12)).otherwise(F.col("id") * 0.5).alias("v"))
    counts = quantile.cut_lineage(quantile.value_counts(rows, [], "v").withColumn("_all", F.lit(0)))
    left = quantile.middle_values(counts, ["_all"])
    assert left.count() <= 2 * n / 1024
    assert quantile.median_of_counts(counts.drop("_all"), [], "m").first().m == statistics.median(
        [1e12 if i == 7 else i * 0.5 for i in range(n)])


def test_no_median_aggregate_over_fact_rows(spark):
    df = spark.createDataFrame(_rows(50), "shipment_id string, route string, v double")
    plan = quantile.grouped_median(df, ["route"], "v", "m")._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "median" not in plan


@pytest.mark.parametrize("bound", [0, 10])
def test_lookup_join_is_the_same_on_both_paths(spark, bound):
    rows = spark.createDataFrame(_rows(500), "shipment_id string, route string, v double")
    table = spark.createDataFrame([("hot", 1.0), ("a", 2.0), ("c", 3.0)], "route string, x double")
    got = lookup.lookup_join(rows, table, ["route"], broadcast_rows=bound, salts=4)
    want = {"hot": 1.0, "a": 2.0}
    out = got.select("shipment_id", "route", "x").collect()
    assert len(out) == 500 and all(x.x == want.get(x.route) for x in out)
    assert got.columns == ["route", "shipment_id", "v", "x"]


def test_missing_delay_is_not_material(spark):
    fit = spark.createDataFrame([("a", "r", 13.0), ("b", "r", None), ("c", "r", 1.0), ("d", "r", None)],
                                "shipment_id string, route string, final_delay_hours double")
    got = encode.route_rate(fit, fit.select("shipment_id", "route")).first()
    assert got.route_material_delay_rate == 0.25


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("nan", float("nan")), ("1.5", 0.9), ("x", 0.1), (None, None)], "t string, p double")
    out = df.select(features.numeric_coerce("t").alias("n"), risk.risk_alert("p").alias("alert")).collect()
    assert [x.n for x in out] == [None, 1.5, None, None] and [x.alert for x in out] == [False, True, False, False]


def test_colliding_levels_keep_their_columns(spark):
    df = spark.createDataFrame([("A-B", "x", "s"), ("A B", "x", "s"), ("C", "x", "s")],
                               "route_id string, carrier string, snapshot_stage string")
    prep = features.fit_preprocessor(df, features.CATEGORICAL)
    hot = prep.one_hot(df).collect()
    names = [c for c in prep.input_columns() if c.startswith("route_id")]
    assert len(names) == 3
    assert all(sum(x[c] for c in names) == 1.0 for x in hot)


def test_risk_metrics_of_an_empty_score_set(spark):
    rows = spark.createDataFrame([("PORT_ARRIVED", None, 1)],
                                 "snapshot_stage string, risk_probability double, target_is_materially_delayed int")
    out = {x.scope: x for x in evaluate.risk_metrics(rows).collect()}
    assert out["ALL"].n_snapshots == 1 and out["ALL"].pr_auc is None and out["ORIGIN_DEPARTED"].n_snapshots == 0
    assert evaluate.risk_metrics(rows.where("false")).count() == 4


def test_sub_second_delays(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS a, timestamp'2024-01-01 04:00:01.9' AS b")
    assert df.select(round_hours_from_micros(micros_between("a", "b")).alias("h")).first().h == 4.001
    assert df.select((micros_between("a", "b") > F.lit(4 * 3_600_000_000)).alias("late")).first().late
