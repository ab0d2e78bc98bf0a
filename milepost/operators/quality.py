"""Rule-based data quality.

``quality_report`` returns one row per rule (rule, description, violations,
passed, sample_ids) computed in few passes: snapshot-local rules share one aggregate over
snapshots, event-local rules one over events, the chronology rule one over
shipments; only referential integrity, the event count per shipment and id
uniqueness shuffle.  ``sample_ids`` names where to look: the smallest offending id of
each of ``SAMPLES`` md5 buckets, plain minima of the same pass.  ``validate`` is the strict mode: it raises for the first
failing rule in rule order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.config import STAGES
from milepost.functions.expr import fold_of
from milepost.operators.derive import ACTUAL

RULES = (
    ("C01", "population: row count and distinct ids equal the expected count"),
    ("C02", "events reference known shipments"),
    ("C03", "snapshots reference known shipments"),
    ("C04", "every shipment present in events has exactly five events"),
    ("C05", "snapshot stage is one of the supported stages"),
    ("C06", "snapshot_id is unique"),
    ("C07", "snapshot target is present"),
    ("C08", "actual milestone chronology is non-decreasing"),
    ("C09", "missing update has no reported_at"),
    ("C10", "reported update has reported_at"),
    ("C11", "reported_at is not before actual_at"),
    ("C12", "S1 snapshot holds no port, customs or truck evidence"),
    ("C13", "S2 snapshot holds no customs or truck evidence"),
)
MESSAGES = {rule: f"data quality rule broken: {text}" for rule, text in RULES}


#: Most ids that a rule's sample holds.
SAMPLES = 5


def sample_ids(cond: Column, key: str = "shipment_id") -> Column:
    """Aggregate: ids of rows where ``cond`` holds, spread over md5 buckets, sorted."""
    bucket = fold_of(key, "sample", SAMPLES)
    least = [F.min(F.when(cond & (bucket == j), F.col(key).cast("string"))) for j in range(SAMPLES)]
    return F.array_sort(F.array_compact(F.array(*least)))


def _rule(name: str, cond: Column, key: str) -> list[Column]:
    return [_count_if(cond).alias(name), sample_ids(cond, key).alias(f"{name}_ids")]


def _count_if(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def chronology_violation() -> F.Column:
    """Any adjacent pair decreasing; NULL gaps do not fail."""
    pairs = [F.col(b) < F.col(a) for a, b in zip(ACTUAL, ACTUAL[1:])]
    return F.coalesce(*[F.greatest(*[F.coalesce(p, F.lit(False)) for p in pairs])], F.lit(False))


def shipment_violations(shipments: DataFrame, expected: int | None = None) -> DataFrame:
    per_id = shipments.groupBy("shipment_id").agg(
        F.count(F.lit(1)).alias("n"), _count_if(chronology_violation()).alias("bad"))
    agg = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("shipment_id").alias("n_ids"),
        sample_ids(F.col("n") > 1).alias("C01_ids"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("C08"), sample_ids(F.col("bad") > 0).alias("C08_ids"))
    exp = F.col("n") if expected is None else F.lit(expected)
    return agg.select(
        (F.abs(F.col("n") - exp) + F.abs(F.col("n_ids") - exp)).cast("bigint").alias("C01"),
        "C01_ids", "C08", "C08_ids")


def event_violations(events: DataFrame) -> DataFrame:
    missing = F.col("is_update_missing").cast("boolean")
    return events.agg(
        *_rule("C09", missing & F.col("reported_at").isNotNull(), "shipment_id"),
        *_rule("C10", ~missing & F.col("reported_at").isNull(), "shipment_id"),
        *_rule("C11", ~missing & (F.col("reported_at") < F.col("actual_at")), "shipment_id"),
    )


def snapshot_violations(snapshots: DataFrame, stages=STAGES) -> DataFrame:
    stage = F.col("snapshot_stage")
    s1_future = ["observed_port_arrival_delay_hours", "observed_customs_delay_hours",
                 "truck_availability_score"]
    s2_future = ["observed_customs_delay_hours", "truck_availability_score"]

    def any_present(cols):
        return F.greatest(*[F.col(c).isNotNull() for c in cols])
    return snapshots.agg(
        *_rule("C05", stage.isNull() | ~stage.isin(list(stages)), "snapshot_id"),
        *_rule("C07", F.col("target_final_delay_hours").isNull()
               | F.isnan(F.col("target_final_delay_hours").cast("double")), "snapshot_id"),
        *_rule("C12", (stage == stages[0]) & any_present(s1_future), "snapshot_id"),
        *_rule("C13", (stage == stages[1]) & any_present(s2_future), "snapshot_id"),
    )


def rows_per_shipment(child: DataFrame) -> DataFrame:
    """shipment_id, n_rows: all that the reference and count rules need of a table."""
    return child.groupBy("shipment_id").agg(F.count(F.lit(1)).alias("n_rows"))


def unknown_references(child: DataFrame, shipments: DataFrame) -> DataFrame:
    """Ids of child rows that are absent from the shipments, with their number
    of rows (NULL ids count as unknown)."""
    return rows_per_shipment(child).join(shipments.select("shipment_id"), "shipment_id", "left_anti")


def unknown_rows(child: DataFrame, shipments: DataFrame, name: str = "violations") -> DataFrame:
    """C2/C3 in one row: number of rows and a sample of the unknown ids."""
    return unknown_references(child, shipments).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias(name),
        sample_ids(F.lit(True)).alias(f"{name}_ids"))


def _counted(bad: DataFrame, name: str) -> DataFrame:
    return bad.agg(F.count(F.lit(1)).cast("bigint").alias(name), sample_ids(F.lit(True)).alias(f"{name}_ids"))


def _repeats(snapshots: DataFrame, name: str) -> DataFrame:
    return duplicate_ids(snapshots).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias(name),
        sample_ids(F.lit(True), "snapshot_id").alias(f"{name}_ids"))


def event_count_violations(events: DataFrame, shipments: DataFrame | None = None,
                           per_shipment: int = 5, strict: bool = False) -> DataFrame:
    """C4: shipments present in events without exactly five events; with
    ``strict`` also shipments that have no events at all."""
    counts = rows_per_shipment(events).withColumnRenamed("n_rows", "n_events")
    bad = counts.where(F.col("n_events") != per_shipment)
    if strict and shipments is not None:
        absent = (shipments.select("shipment_id").join(counts, "shipment_id", "left_anti")
                  .withColumn("n_events", F.lit(0).cast("bigint")))
        bad = bad.unionByName(absent)
    return bad


def duplicate_ids(snapshots: DataFrame) -> DataFrame:
    """Snapshot ids occurring more than once (NULLs group together)."""
    return (snapshots.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def quality_report(shipments: DataFrame, events: DataFrame, snapshots: DataFrame,
                   expected_shipments: int | None = None, stages=STAGES,
                   strict_event_count: bool = False) -> DataFrame:
    """One row per rule: rule, description, violations, sample_ids, passed."""
    wide = (shipment_violations(shipments, expected_shipments)
            .crossJoin(event_violations(events))  # single-row frames
            .crossJoin(snapshot_violations(snapshots, stages))
            .crossJoin(unknown_rows(events, shipments, "C02"))
            .crossJoin(unknown_rows(snapshots, shipments, "C03"))
            .crossJoin(_counted(event_count_violations(events, shipments, strict=strict_event_count), "C04"))
            .crossJoin(_repeats(snapshots, "C06")))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(d).alias("description"), F.col(r).alias("violations"),
                               F.col(f"{r}_ids").alias("sample_ids")) for r, d in RULES])
    return (wide.select(F.inline(rules))
            .withColumn("passed", F.col("violations") == 0))


def validate(shipments: DataFrame, events: DataFrame, snapshots: DataFrame,
             expected_shipments: int | None = None, stages=STAGES) -> DataFrame:
    """Strict mode: raise ValueError for the first failed rule, in rule order.
    Returns the (13-row) report when every rule passes."""
    report = quality_report(shipments, events, snapshots, expected_shipments, stages)
    rows = sorted(report.collect(), key=lambda r: r["rule"])  # 13 rows
    for r in rows:
        if r["violations"]:
            raise ValueError(f"{MESSAGES[r['rule']]} ({r['rule']}: {r['violations']})")
    return report


def rule_violations(rule: str, shipments: DataFrame, events: DataFrame, snapshots: DataFrame,
                    expected_shipments: int | None = None, stages=STAGES) -> DataFrame:
    """A single rule in one row: violations, sample_ids."""
    if rule in ("C01", "C08"):
        own = shipment_violations(shipments, expected_shipments)
    elif rule == "C02":
        own = unknown_rows(events, shipments, rule)
    elif rule == "C03":
        own = unknown_rows(snapshots, shipments, rule)
    elif rule == "C04":
        own = _counted(event_count_violations(events, shipments), rule)
    elif rule == "C06":
        own = _repeats(snapshots, rule)
    elif rule in ("C09", "C10", "C11"):
        own = event_violations(events)
    else:
        own = snapshot_violations(snapshots, stages)
    return own.select(F.col(rule).alias("violations"), F.col(f"{rule}_ids").alias("sample_ids"))
