"""Journey tables are derived once for all that reads them, and written without sorting."""
from milepost.plans import queries as Q
from milepost.plans.catalog import load
from tests.conftest import SF_SMALL


def reads_given_tables(df) -> bool:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return any(c in plan for c in ("l_orderkey", "o_orderkey"))


def test_scored_rows_and_the_split_read_stored_legs(spark):
    t = load(spark, SF_SMALL)
    assert t.materialize() is t.materialize() and t.materialize().materialize() is t.materialize()
    for df in (Q._final_rows(t), Q.q_risk_frame(t), t.materialize().manifest, t.materialize().snapshots_of("train")):
        assert not reads_given_tables(df)


def test_stored_legs_give_the_same_tables(spark):
    t = load(spark, SF_SMALL)
    kept = t.materialize()
    for name in ("shipments", "events", "snapshots", "manifest"):
        a, b = getattr(t, name), getattr(kept, name)
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    a, b = t.snapshots_of("validation", "test"), kept.snapshots_of("validation", "test")
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_fitted_rows_are_not_looked_up(spark):
    plan = Q.q_risk_frame(load(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "shipment_id" not in "".join(x for x in plan.splitlines() if "Join " in x)


def test_stages_are_written_without_a_sort(small):
    """A task has a file open for each stage, so its rows don't wait in memory to be sorted."""
    spark = small.snapshots.sparkSession
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= len(small.cfg.stages)
