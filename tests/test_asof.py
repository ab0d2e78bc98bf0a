"""B8 on event streams: against a plain loop, with ties, repeats, missing parts and hot keys."""
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from milepost.config import MILESTONES
from milepost.operators import asof
from milepost.operators import derive as D

T0 = datetime(2024, 1, 1)
KINDS = ["a", "b", "c"]
REPORTS = "key string, milestone string, at timestamp, report_id long, value double"
TRIGGERS = "key string, at timestamp, trigger_id long, value string"


def _brute(triggers, reports):
    out = set()
    for key, at, tid, _ in triggers:
        row = [tid]
        for m in KINDS:
            seen = sorted(((r[2], r[3], r[4]) for r in reports if key is not None and at is not None and r[0] == key
                           and r[1] == m and r[2] is not None and r[2] <= at), key=lambda x: x[:2])
            row += [seen[0][0], seen[-1][0], seen[-1][2], len(seen)] if seen else [None, None, None, 0]
        out.add(tuple(row))
    return out


def _state(spark, triggers, reports, stretch=asof.STRETCH):
    got = asof.asof_state(spark.createDataFrame(triggers, TRIGGERS), spark.createDataFrame(reports, REPORTS),
                          ["key"], KINDS, stretch=stretch)
    columns = ["trigger_id"] + [f"{m}_{x}" for m in KINDS for x in ("first_at", "last_at", "last_value", "reports")]
    assert got.columns == ["key", "at", "trigger_id", "value"] + columns[1:]
    return got.select(*columns).collect()


def _case(seed, keys, n, span):
    rng = random.Random(seed)
    when = lambda: T0 + timedelta(seconds=rng.randrange(span))
    reports = [(rng.choice(keys), rng.choice(KINDS + ["other"]), rng.choice([when(), when(), when(), None]), i, float(i))
               for i in range(n)]
    reports += [(None, "a", when(), n + 1, 1.0)]
    triggers = [(rng.choice(keys), when(), i, "x") for i in range(n // 3)]
    triggers += [(None, T0, n, "x"), (keys[0], None, n + 1, "x"), ("absent", T0, n + 2, "x"),
                 (keys[0], T0 - timedelta(days=1), n + 3, "x"), (keys[0], T0 + timedelta(seconds=span), n + 4, "x")]
    return triggers, reports


@pytest.mark.parametrize("stretch", [10 ** 6, 40, 1])
def test_state_equals_a_plain_loop(spark, stretch):
    # one key holds most rows; instants tie and repeat
    triggers, reports = _case(3, ["hot"] * 8 + ["k1", "k2"], 500, 300)
    got = _state(spark, triggers, reports, stretch)
    assert len(got) == len(triggers) and {tuple(r) for r in got} == _brute(triggers, reports)


def test_equal_triggers_and_repeated_reports_stay(spark):
    report = ("k", "a", T0, 1, 7.0)
    got = _state(spark, [("k", T0, 1, "x"), ("k", T0, 1, "x")], [report, report])
    assert [tuple(r) for r in got] == [(1, T0, T0, 7.0, 2, None, None, None, 0, None, None, None, 0)] * 2


def test_empty_sides(spark):
    assert _state(spark, [], [("k", "a", T0, 1, 7.0)]) == []
    assert [r.a_reports for r in _state(spark, [("k", T0, 1, "x")], [])] == [0]


def test_hot_key_is_cut_into_even_stretches(spark):
    rows = spark.range(60_000).select(F.lit("hot").alias("key"), F.timestamp_seconds(F.col("id") % 50_000).alias("_at"))
    rows = rows.union(spark.range(50).select(F.lit("cold"), F.timestamp_seconds("id"))).distinct()
    large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_d")).where("_d > 1000")
    sizes = asof._stretched(rows, large, ["key"], 1000).groupBy("key", "_b").count().collect()
    assert max(r["count"] for r in sizes) < 8 * 1000
    assert sum(r["count"] for r in sizes) == 50_050 and [r._b for r in sizes if r.key == "cold"] == [0]


def test_equals_the_wide_path_on_journeys(small):
    late = small.events.withColumn("reported_at", F.col("reported_at") - F.expr("interval 1 hour"))
    # every report twice, the earlier copy first: the snapshot is taken at the later one
    rows = asof.available_as_of(small.events.union(late)).select(
        "shipment_id", "snapshot_stage", "snapshot_at", "milestone")
    once = asof.available_as_of(small.events)
    number = F.create_map(*[F.lit(x) for i, m in enumerate(MILESTONES) for x in (m, str(i + 1))])
    mine = once.select(F.concat_ws("-", "shipment_id", number[F.col("snapshot_stage")]).alias("snapshot_id"), "milestone")
    want = D.available_milestones(small.journeys)
    assert mine.count() == want.count() > 1000 and mine.exceptAll(want).isEmpty()
    # a milestone's earlier copy can only add what was visible
    assert once.select(rows.columns).join(rows, rows.columns, "left_anti").isEmpty()


def test_all_five_milestones(small):
    rows = asof.available_as_of(small.events, stages=MILESTONES)
    last = rows.where(F.col("snapshot_stage") == MILESTONES[-1])
    seen = last.groupBy("shipment_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.min("n")).first()
    assert seen[0] == 5 and seen[1] >= 1


def test_only_what_is_asked_for(spark):
    at = lambda h: datetime(2024, 1, 1, h)
    reports = spark.createDataFrame([("a", at(h), m, f"r{i}", float(i)) for i, (h, m) in enumerate(
        [(1, "x"), (2, "y"), (2, "x"), (5, "y"), (7, "x")])] + [(None, at(1), "x", "n", 0.0)],
        "k string, at timestamp, milestone string, report_id string, value double")
    triggers = spark.createDataFrame([("a", at(2), "p"), ("a", at(2), "q"), ("a", at(6), "r"), ("b", at(9), "s"), (None, at(3), "t"),
                                      ("a", None, "u")], "k string, at timestamp, name string")
    for stretch in (1, 100):  # cut and by key
        got = asof.asof_state(triggers, reports, ["k"], ["x", "y"], stretch=stretch, fields=("reports",))
        assert got.columns == ["k", "at", "name", "x_reports", "y_reports"]
        assert sorted((r.name, r.x_reports, r.y_reports) for r in got.collect()) == [
            ("p", 2, 1), ("q", 2, 1), ("r", 2, 2), ("s", 0, 0), ("t", 0, 0), ("u", 0, 0)]
        full = asof.asof_state(triggers, reports, ["k"], ["x", "y"], stretch=stretch)
        assert {r.name: (r.x_first_at, r.x_last_value, r.y_last_at) for r in full.collect()}["r"] == (at(1), 2.0, at(5))


def test_small_keys_are_dealt_once(small):
    """Beside the count of latest reports: one exchange of triggers and reports."""
    plan = asof.available_as_of(small.events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
