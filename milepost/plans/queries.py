"""Registered queries: one per operator of the inventory, each paired with its
DuckDB oracle statement.  Every query reads the given tables at full size.

Scopes: *fit* = train split, *prediction* = validation split (the train-only
validation pass); final-scope metrics fit on train + validation and score test.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.config import MILESTONES, Config
from milepost.operators import asof, derive
from milepost.plans import oracle as O
from milepost.plans.catalog import Journeys, load
from milepost.session import configure

REGISTRY: dict[str, "Query"] = {}


@dataclass
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def register(name: str, sql: str | None = None, cfg: Config | None = None, tables: bool = False):
    """A query on the journey tables, or on the given ``tables`` as they are."""
    def deco(fn: Callable[..., DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(load(spark, sf_dir, cfg or Config()))

        def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)
        REGISTRY[name] = Query(name, plain if tables else run, sql)
        return fn
    return deco


def r6(c) -> F.Column:
    """Round float aggregates (summation order differs between engines)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- B1-B12

@register("shipments", O.sql(f"SELECT {O.SHIPMENT_COLS} FROM shipments_t"))
def q_shipments(t: Journeys) -> DataFrame:
    return t.shipments


@register("planned_schedule", O.sql(
    "SELECT shipment_id, scheduled_departure_at, scheduled_port_arrival_at, "
    "scheduled_customs_clearance_at, scheduled_inland_dispatch_at, scheduled_final_eta FROM j"))
def q_planned_schedule(t: Journeys) -> DataFrame:
    return t.journeys.select("shipment_id", *derive.SCHEDULED)


@register("delay_hours", O.sql(
    "SELECT shipment_id, departure_delay_hours, port_arrival_delay_hours, customs_delay_hours, "
    "final_delay_hours FROM j"))
def q_delay_hours(t: Journeys) -> DataFrame:
    return t.journeys.select("shipment_id", "departure_delay_hours", "port_arrival_delay_hours",
                             "customs_delay_hours", "final_delay_hours")


@register("incremental_delays", O.sql(
    "SELECT shipment_id, customs_incremental_delay_hours, inland_incremental_delay_hours FROM j"))
def q_incremental(t: Journeys) -> DataFrame:
    return t.journeys.select("shipment_id", "customs_incremental_delay_hours",
                             "inland_incremental_delay_hours")


@register("material_label", O.sql(
    "SELECT shipment_id, final_delay_hours, is_materially_delayed FROM j"))
def q_material(t: Journeys) -> DataFrame:
    return t.journeys.select("shipment_id", "final_delay_hours", "is_materially_delayed")


@register("milestone_events", O.sql(
    "SELECT shipment_id, milestone, location, scheduled_at, actual_at, delay_vs_schedule_hours, "
    "reported_at, is_update_missing, is_late_update, update_delay_hours FROM mevents"))
def q_events(t: Journeys) -> DataFrame:
    return t.events


@register("update_status", O.sql(
    "SELECT shipment_id, milestone, is_update_missing, is_late_update, update_delay_hours FROM mevents"))
def q_update_status(t: Journeys) -> DataFrame:
    return t.events.select("shipment_id", "milestone", "is_update_missing", "is_late_update",
                           "update_delay_hours")


@register("snapshot_trigger", O.sql(
    "SELECT snapshot_id, shipment_id, snapshot_stage, snapshot_at FROM snaps"))
def q_trigger(t: Journeys) -> DataFrame:
    return t.snapshots.select("snapshot_id", "shipment_id", "snapshot_stage", "snapshot_at")


@register("asof_availability", O.sql(
    "\nUNION ALL\n".join(
        f"SELECT shipment_id || '-{i + 1}' AS snapshot_id, '{O.MILESTONE_NAMES[j]}' AS milestone FROM w WHERE r{j} <= r{i}"
        for i in range(3) for j in range(i + 1)),
    O.REPORTS))
def q_asof(t: Journeys) -> DataFrame:
    return derive.available_milestones(t.journeys)


_EVENT_KINDS = ("view", "click", "error", "signup")


@register("asof_event_state", f"""
SELECT t.event_id, t.user_id, t.ts, {", ".join(
    f"""min(r.ts) FILTER (WHERE r.event_type = '{m}') AS {m}_first_at, max(r.ts) FILTER (WHERE r.event_type = '{m}') AS {m}_last_at,
last(r.value ORDER BY r.ts, r.event_id) FILTER (WHERE r.event_type = '{m}') AS {m}_last_value,
CAST(count(*) FILTER (WHERE r.event_type = '{m}') AS BIGINT) AS {m}_reports""" for m in _EVENT_KINDS)}
FROM events t LEFT JOIN events r ON r.user_id = t.user_id AND r.ts <= t.ts
WHERE t.event_type = 'purchase' GROUP BY t.event_id, t.user_id, t.ts""", tables=True)
def q_asof_event_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 on a stream of any events: what each user had done before each purchase."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    triggers = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    return asof.asof_state(triggers, events, ["user_id"], _EVENT_KINDS, at="ts", report_at="ts",
                           milestone="event_type", order="event_id")


@register("asof_five_milestones", O.sql(
    "SELECT t.shipment_id, t.milestone AS snapshot_stage, t.reported_at AS snapshot_at, e.milestone, CAST(1 AS BIGINT) AS reports "
    "FROM mevents t JOIN mevents e ON e.shipment_id = t.shipment_id AND e.milestone_idx <= t.milestone_idx "
    "AND e.reported_at <= t.reported_at"))
def q_asof_five(t: Journeys) -> DataFrame:
    """B8 on the events table with all five milestones as stages."""
    return asof.available_as_of(t.materialize().events, stages=MILESTONES)  # read twice


@register("evidence_gating", O.sql(
    "SELECT snapshot_id, observed_departure_delay_hours, observed_port_arrival_delay_hours, "
    "observed_customs_delay_hours, truck_availability_score FROM snaps"))
def q_gating(t: Journeys) -> DataFrame:
    return t.snapshots.select("snapshot_id", "observed_departure_delay_hours",
                              "observed_port_arrival_delay_hours", "observed_customs_delay_hours",
                              "truck_availability_score")


@register("completeness", O.sql(
    "SELECT snapshot_id, upstream_missing_update_count, event_completeness_score FROM snaps"))
def q_completeness(t: Journeys) -> DataFrame:
    return t.snapshots.select("snapshot_id", "upstream_missing_update_count",
                              "event_completeness_score")


@register("target_attach", O.sql(
    "SELECT snapshot_id, target_final_delay_hours, target_is_materially_delayed, "
    "target_actual_final_delivery_at FROM snaps"))
def q_targets(t: Journeys) -> DataFrame:
    return t.snapshots.select("snapshot_id", "target_final_delay_hours",
                              "target_is_materially_delayed", "target_actual_final_delivery_at")


@register("iso_format", O.sql(
    f"SELECT snapshot_id, {O.ISO('snapshot_at')} AS snapshot_at_iso, "
    f"{O.ISO('scheduled_final_eta')} AS scheduled_final_eta_iso, "
    f"{O.ISO('target_actual_final_delivery_at')} AS target_actual_final_delivery_at_iso FROM snaps"))
def q_iso(t: Journeys) -> DataFrame:
    cols = ["snapshot_at", "scheduled_final_eta", "target_actual_final_delivery_at"]
    return derive.iso_format(t.snapshots.select("snapshot_id", *cols), cols).drop(*cols)


@register("snapshots", O.sql("SELECT * FROM snaps"))
def q_snapshots(t: Journeys) -> DataFrame:
    return t.snapshots


@register("snapshots_events_path", O.sql("SELECT * FROM snaps"))
def q_snapshots_events(t: Journeys) -> DataFrame:
    """B7-B11 from the events table: fixed-size pivot per shipment + join."""
    return derive.snapshots_from_events(t.shipments, t.events)


# ---------------------------------------------------------------- C1-C13
from milepost.operators import quality  # noqa: E402

_RULE_ROWS = "\n  UNION ALL ".join(
    f"SELECT '{r}' AS rule, '{d}' AS description, CAST(({{{r}}}) AS BIGINT) AS violations, ({{{r}_ids}}) AS sample_ids"
    for r, d in quality.RULES)

_ACT = ["actual_departure_at", "actual_port_arrival_at", "actual_customs_clearance_at",
        "actual_inland_dispatch_at", "actual_final_delivery_at"]
_CHRONO = " OR ".join(f"coalesce({b} < {a}, false)" for a, b in zip(_ACT, _ACT[1:]))


def _sample_sql(ids: str) -> str:
    """The smallest of the ids in each md5 bucket, joined in order."""
    return (f"SELECT coalesce(string_agg(id, ',' ORDER BY id), '') FROM (SELECT min(CAST(id AS VARCHAR)) AS id FROM ({ids}) "
            f"WHERE id IS NOT NULL GROUP BY {O.FOLD('CAST(id AS VARCHAR)', 'sample', quality.SAMPLES)})")


def _rule_sql(sh: str, ev: str, sn: str, expected: str | None = None) -> dict:
    exp = expected or f"(SELECT count(*) FROM {sh})"

    def unknown(child: str) -> str:
        return f"FROM {child} e WHERE NOT EXISTS (SELECT 1 FROM {sh} s WHERE s.shipment_id = e.shipment_id)"

    evidence = "observed_customs_delay_hours IS NOT NULL OR truck_availability_score IS NOT NULL"
    rows = {  # offending rows and the id that names them
        "C05": (f"FROM {sn} WHERE snapshot_stage IS NULL OR snapshot_stage NOT IN ('ORIGIN_DEPARTED', 'PORT_ARRIVED', 'CUSTOMS_CLEARED')", "snapshot_id"),
        "C07": (f"FROM {sn} WHERE target_final_delay_hours IS NULL", "snapshot_id"),
        "C08": (f"FROM {sh} WHERE {_CHRONO}", "shipment_id"),
        "C09": (f"FROM {ev} WHERE is_update_missing AND reported_at IS NOT NULL", "shipment_id"),
        "C10": (f"FROM {ev} WHERE NOT is_update_missing AND reported_at IS NULL", "shipment_id"),
        "C11": (f"FROM {ev} WHERE NOT is_update_missing AND reported_at < actual_at", "shipment_id"),
        "C12": (f"FROM {sn} WHERE snapshot_stage = 'ORIGIN_DEPARTED' AND (observed_port_arrival_delay_hours IS NOT NULL OR {evidence})", "snapshot_id"),
        "C13": (f"FROM {sn} WHERE snapshot_stage = 'PORT_ARRIVED' AND ({evidence})", "snapshot_id"),
        "C02": (unknown(ev), "shipment_id"), "C03": (unknown(sn), "shipment_id"),
        "C04": (f"FROM (SELECT shipment_id, count(*) AS n FROM {ev} GROUP BY shipment_id) WHERE n <> 5", "shipment_id")}
    out = {r: f"SELECT count(*) {x}" for r, (x, _) in rows.items()}
    out["C01"] = f"SELECT abs((SELECT count(*) FROM {sh}) - {exp}) + abs((SELECT count(DISTINCT shipment_id) FROM {sh}) - {exp})"
    out["C06"] = f"SELECT coalesce(sum(n - 1), 0) FROM (SELECT snapshot_id, count(*) AS n FROM {sn} GROUP BY snapshot_id HAVING count(*) > 1)"
    rows |= {"C01": (f"FROM {sh} GROUP BY shipment_id HAVING count(*) > 1", "shipment_id"),
             "C06": (f"FROM {sn} GROUP BY snapshot_id HAVING count(*) > 1", "snapshot_id")}
    return out | {f"{r}_ids": _sample_sql(f"SELECT {key} AS id {x}") for r, (x, key) in rows.items()}


@register("quality_report", O.sql(
    "SELECT rule, description, violations, violations = 0 AS passed, sample_ids FROM (\n  "
    + _RULE_ROWS.format(**_rule_sql("shipments_t", "mevents", "snaps")) + ")"))
def q_quality(t: Journeys) -> DataFrame:
    report = quality.quality_report(t.shipments, t.events, t.snapshots)
    return report.withColumn("sample_ids", F.array_join("sample_ids", ","))


# One deterministic fault per rule, injected into the rows that match a data
# attribute (the whole tables are still scanned and checked).
_MUTATIONS_SQL = {
    "C01": ("(SELECT * FROM shipments_t UNION ALL SELECT * FROM shipments_t WHERE carrier = '1-URGENT' AND cargo_type = 'BUILDING')", "mevents", "snaps"),
    "C02": ("shipments_t", "(SELECT * REPLACE (CASE WHEN milestone = 'ORIGIN_DEPARTED' AND is_late_update THEN 'UNKNOWN-' || shipment_id ELSE shipment_id END AS shipment_id) FROM mevents)", "snaps"),
    "C03": ("shipments_t", "mevents", "(SELECT * REPLACE (CASE WHEN snapshot_stage = 'CUSTOMS_CLEARED' AND cargo_type = 'AUTOMOBILE' THEN 'UNKNOWN-' || shipment_id ELSE shipment_id END AS shipment_id) FROM snaps)"),
    "C04": ("shipments_t", "(SELECT * FROM mevents WHERE NOT (milestone = 'INLAND_DISPATCHED' AND is_late_update))", "snaps"),
    "C05": ("shipments_t", "mevents", "(SELECT * REPLACE (CASE WHEN cargo_type = 'MACHINERY' AND snapshot_stage = 'PORT_ARRIVED' THEN NULL ELSE snapshot_stage END AS snapshot_stage) FROM snaps)"),
    "C06": ("shipments_t", "mevents", "(SELECT * REPLACE (CASE WHEN snapshot_stage = 'PORT_ARRIVED' AND carrier = '5-LOW' THEN shipment_id || '-1' ELSE snapshot_id END AS snapshot_id) FROM snaps)"),
    "C07": ("shipments_t", "mevents", "(SELECT * REPLACE (CASE WHEN carrier = '2-HIGH' AND snapshot_stage = 'ORIGIN_DEPARTED' THEN NULL ELSE target_final_delay_hours END AS target_final_delay_hours) FROM snaps)"),
    "C08": ("(SELECT * REPLACE (CASE WHEN cargo_type = 'FURNITURE' THEN actual_departure_at - INTERVAL 1 HOUR ELSE actual_port_arrival_at END AS actual_port_arrival_at) FROM shipments_t)", "mevents", "snaps"),
    "C09": ("shipments_t", "(SELECT * REPLACE (CASE WHEN is_update_missing AND milestone = 'CUSTOMS_CLEARED' THEN actual_at ELSE reported_at END AS reported_at) FROM mevents)", "snaps"),
    "C10": ("shipments_t", "(SELECT * REPLACE (CASE WHEN NOT is_update_missing AND is_late_update AND milestone = 'PORT_ARRIVED' THEN NULL ELSE reported_at END AS reported_at) FROM mevents)", "snaps"),
    "C11": ("shipments_t", "(SELECT * REPLACE (CASE WHEN NOT is_update_missing AND is_late_update AND milestone = 'FINAL_DELIVERED' THEN actual_at - INTERVAL 1 HOUR ELSE reported_at END AS reported_at) FROM mevents)", "snaps"),
    "C12": ("shipments_t", "mevents", "(SELECT * REPLACE (CASE WHEN snapshot_stage = 'ORIGIN_DEPARTED' AND carrier = '3-MEDIUM' THEN 1.0 ELSE observed_port_arrival_delay_hours END AS observed_port_arrival_delay_hours) FROM snaps)"),
    "C13": ("shipments_t", "mevents", "(SELECT * REPLACE (CASE WHEN snapshot_stage = 'PORT_ARRIVED' AND cargo_type = 'HOUSEHOLD' THEN 0.5 ELSE truck_availability_score END AS truck_availability_score) FROM snaps)"),
}


def _mutate(rule: str, t: Journeys):
    sh, ev, sn = t.shipments, t.events, t.snapshots
    w = F.when
    if rule == "C01":
        sh = sh.unionByName(sh.where((F.col("carrier") == "1-URGENT") & (F.col("cargo_type") == "BUILDING")))
    elif rule == "C02":
        ev = ev.withColumn("shipment_id", w((F.col("milestone") == "ORIGIN_DEPARTED") & F.col("is_late_update"),
                                            F.concat(F.lit("UNKNOWN-"), "shipment_id")).otherwise(F.col("shipment_id")))
    elif rule == "C03":
        sn = sn.withColumn("shipment_id", w((F.col("snapshot_stage") == "CUSTOMS_CLEARED") & (F.col("cargo_type") == "AUTOMOBILE"),
                                            F.concat(F.lit("UNKNOWN-"), "shipment_id")).otherwise(F.col("shipment_id")))
    elif rule == "C04":
        ev = ev.where(~((F.col("milestone") == "INLAND_DISPATCHED") & F.col("is_late_update")))
    elif rule == "C05":
        sn = sn.withColumn("snapshot_stage", w((F.col("cargo_type") == "MACHINERY") & (F.col("snapshot_stage") == "PORT_ARRIVED"),
                                               F.lit(None).cast("string")).otherwise(F.col("snapshot_stage")))
    elif rule == "C06":
        sn = sn.withColumn("snapshot_id", w((F.col("snapshot_stage") == "PORT_ARRIVED") & (F.col("carrier") == "5-LOW"),
                                            F.concat("shipment_id", F.lit("-1"))).otherwise(F.col("snapshot_id")))
    elif rule == "C07":
        sn = sn.withColumn("target_final_delay_hours", w((F.col("carrier") == "2-HIGH") & (F.col("snapshot_stage") == "ORIGIN_DEPARTED"),
                                                         F.lit(None).cast("double")).otherwise(F.col("target_final_delay_hours")))
    elif rule == "C08":
        sh = sh.withColumn("actual_port_arrival_at", w(F.col("cargo_type") == "FURNITURE",
                                                       F.timestamp_add("HOUR", F.lit(-1), "actual_departure_at"))
                           .otherwise(F.col("actual_port_arrival_at")))
    elif rule == "C09":
        ev = ev.withColumn("reported_at", w(F.col("is_update_missing") & (F.col("milestone") == "CUSTOMS_CLEARED"),
                                            F.col("actual_at")).otherwise(F.col("reported_at")))
    elif rule == "C10":
        ev = ev.withColumn("reported_at", w(~F.col("is_update_missing") & F.col("is_late_update") & (F.col("milestone") == "PORT_ARRIVED"),
                                            F.lit(None)).otherwise(F.col("reported_at")))
    elif rule == "C11":
        ev = ev.withColumn("reported_at", w(~F.col("is_update_missing") & F.col("is_late_update") & (F.col("milestone") == "FINAL_DELIVERED"),
                                            F.timestamp_add("HOUR", F.lit(-1), "actual_at")).otherwise(F.col("reported_at")))
    elif rule == "C12":
        sn = sn.withColumn("observed_port_arrival_delay_hours", w((F.col("snapshot_stage") == "ORIGIN_DEPARTED") & (F.col("carrier") == "3-MEDIUM"),
                                                                  F.lit(1.0)).otherwise(F.col("observed_port_arrival_delay_hours")))
    elif rule == "C13":
        sn = sn.withColumn("truck_availability_score", w((F.col("snapshot_stage") == "PORT_ARRIVED") & (F.col("cargo_type") == "HOUSEHOLD"),
                                                         F.lit(0.5)).otherwise(F.col("truck_availability_score")))
    return sh, ev, sn


def _mutation_query(rule: str):
    sh_sql, ev_sql, sn_sql = _MUTATIONS_SQL[rule]
    expected = "(SELECT count(*) FROM shipments_t)"
    parts = _rule_sql("m_sh", "m_ev", "m_sn", expected)
    body, ids = parts[rule], parts[f"{rule}_ids"]
    extra = f"m_sh AS (SELECT * FROM {sh_sql}),\nm_ev AS (SELECT * FROM {ev_sql}),\nm_sn AS (SELECT * FROM {sn_sql})"
    sql_text = O.sql(f"SELECT '{rule}' AS rule, CAST(({body}) AS BIGINT) AS violations, ({ids}) AS sample_ids", extra)

    def fn(t: Journeys) -> DataFrame:
        n = t.shipments.count() if rule == "C01" else None  # expected population (one number)
        sh, ev, sn = _mutate(rule, t)
        return quality.rule_violations(rule, sh, ev, sn, n).select(
            F.lit(rule).alias("rule"), "violations", F.array_join("sample_ids", ",").alias("sample_ids"))
    register(f"quality_mutation_{rule.lower()}", sql_text)(fn)


for _rule, _ in quality.RULES:
    _mutation_query(_rule)


# ---------------------------------------------------------------- D1-D4
from milepost.operators import split as S  # noqa: E402


@register("split_manifest", O.sql("SELECT shipment_id, split, split_seed FROM manifest"))
def q_manifest(t: Journeys) -> DataFrame:
    return t.manifest


@register("rows_by_split", O.sql(
    "SELECT m.split, CAST(count(DISTINCT m.shipment_id) AS BIGINT) AS n_shipments, "
    "CAST(count(s.snapshot_id) AS BIGINT) AS n_snapshots FROM manifest m "
    "LEFT JOIN snaps s USING (shipment_id) GROUP BY m.split"))
def q_rows_by_split(t: Journeys) -> DataFrame:
    ships = t.manifest.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n_shipments"))
    snaps = (S.with_split(t.snapshots, t.manifest).groupBy("split")
             .agg(F.count(F.lit(1)).cast("bigint").alias("n_snapshots")))
    return ships.join(snaps, "split", "left").select(
        "split", "n_shipments", F.coalesce("n_snapshots", F.lit(0).cast("bigint")).alias("n_snapshots"))


@register("group_folds", O.sql(f"SELECT shipment_id, {O.FOLD('shipment_id')} AS fold FROM ship_s WHERE split = 'train'"))
def q_group_folds(t: Journeys) -> DataFrame:
    return S.group_folds(t.shipments_of("train").select("shipment_id"), t.cfg.folds, t.cfg.fold_salt(0))


@register("split_leak_check", O.sql(
    "SELECT CAST(count(*) AS BIGINT) AS leaking_shipments FROM "
    "(SELECT shipment_id FROM manifest GROUP BY shipment_id HAVING count(DISTINCT split) > 1)"))
def q_leak(t: Journeys) -> DataFrame:
    return S.split_leak_check(t.manifest).agg(F.count(F.lit(1)).cast("bigint").alias("leaking_shipments"))


@register("fold_isolation", O.sql(
    "SELECT h.fold, CAST(count(*) AS BIGINT) AS held_shipments, "
    "CAST(count(*) FILTER (WHERE EXISTS (SELECT 1 FROM f WHERE f.shipment_id = h.shipment_id AND f.fold <> h.fold)) AS BIGINT) AS overlap "
    "FROM f h GROUP BY h.fold",
    f"f AS (SELECT DISTINCT shipment_id, {O.FOLD('shipment_id')} AS fold FROM snaps_s WHERE split = 'train')"))
def q_fold_isolation(t: Journeys) -> DataFrame:
    """D4 on the row sets that each fold's fit and prediction get: shipments held
    out, and those among them that the fit sees too (expected 0)."""
    from milepost.operators.eta import fold_parts
    rows = S.group_folds(t.snapshots_of("train"), t.cfg.folds, t.cfg.fold_salt(0), name="_fold")
    out = None
    for k in range(t.cfg.folds):
        fit, held = fold_parts(rows, k, "_fold")
        held = held.select("shipment_id").distinct()
        one = held.agg(F.lit(k).alias("fold"), F.count(F.lit(1)).cast("bigint").alias("held_shipments")).crossJoin(
            S.fold_overlap(fit, held).agg(F.count(F.lit(1)).cast("bigint").alias("overlap")))  # one row each
        out = one if out is None else out.unionByName(one)
    return out.where("held_shipments > 0")


# ---------------------------------------------------------------- F1-F15
from milepost.functions.expr import latest_observed  # noqa: E402
from milepost.operators import encode as EN  # noqa: E402
from milepost.operators import features as FE  # noqa: E402

_NUM8 = FE.NUMERIC[2:]
_START = ("CASE snapshot_stage WHEN 'ORIGIN_DEPARTED' THEN scheduled_departure_at "
          "WHEN 'PORT_ARRIVED' THEN scheduled_port_arrival_at "
          "WHEN 'CUSTOMS_CLEARED' THEN scheduled_customs_clearance_at END")
_DOW = (f"CAST(isodow(CASE WHEN snapshot_stage = 'ORIGIN_DEPARTED' THEN scheduled_departure_at "
        f"WHEN snapshot_stage IN ('PORT_ARRIVED', 'CUSTOMS_CLEARED') THEN scheduled_port_arrival_at END) - 1 AS DOUBLE)")
_BASE_SQL = (f"route AS route_id, carrier, snapshot_stage, "
             f"{O.EXACT_HOURS(_START, 'scheduled_final_eta')} AS planned_remaining_hours, "
             f"{_DOW} AS calendar_day_of_week, "
             + ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in _NUM8))
_INTER_SQL = ("observed_port_arrival_delay_hours * congestion_score AS port_delay_x_congestion, "
              "observed_port_arrival_delay_hours * (1 - document_readiness_score) AS port_delay_x_document_gap, "
              "observed_customs_delay_hours * (1 - truck_availability_score) AS customs_delay_x_truck_shortage")


@register("planned_remaining", O.sql(
    f"SELECT snapshot_id, {O.EXACT_HOURS(_START, 'scheduled_final_eta')} AS planned_remaining_hours FROM snaps"))
def q_planned_remaining(t: Journeys) -> DataFrame:
    return t.snapshots.select("snapshot_id", FE.planned_remaining().alias("planned_remaining_hours"))


@register("calendar_dow", O.sql(f"SELECT snapshot_id, {_DOW} AS calendar_day_of_week FROM snaps"))
def q_dow(t: Journeys) -> DataFrame:
    return t.snapshots.select("snapshot_id", FE.calendar_dow().alias("calendar_day_of_week"))


@register("numeric_coerce", O.sql(
    "SELECT snapshot_id, " + ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in _NUM8) + " FROM snaps"))
def q_coerce(t: Journeys) -> DataFrame:
    return t.snapshots.select("snapshot_id", *[FE.numeric_coerce(c).alias(c) for c in _NUM8])


@register("feature_frame", O.sql(f"SELECT snapshot_id, {_BASE_SQL} FROM snaps"))
def q_feature_frame(t: Journeys) -> DataFrame:
    return FE.base_features(t.snapshots)


@register("latest_observed", O.sql(f"SELECT snapshot_id, {O.LATEST()} AS latest_observed_delay_hours FROM snaps"))
def q_latest(t: Journeys) -> DataFrame:
    return t.snapshots.select("snapshot_id", latest_observed().alias("latest_observed_delay_hours"))


@register("interactions", O.sql(f"SELECT snapshot_id, {_INTER_SQL} FROM snaps"))
def q_interactions(t: Journeys) -> DataFrame:
    return FE.interactions(t.snapshots).select("snapshot_id", *FE.INTERACTIONS)


_TYP_FIT = f"""
tfit AS (SELECT route, snapshot_stage, {O.LATEST()} AS latest FROM snaps_s WHERE split = 'train'),
trs AS (SELECT route, snapshot_stage, median(latest) AS typical_route_stage FROM tfit
        WHERE route IS NOT NULL AND snapshot_stage IS NOT NULL GROUP BY route, snapshot_stage),
tst AS (SELECT snapshot_stage, median(latest) AS typical_stage FROM tfit
        WHERE snapshot_stage IS NOT NULL GROUP BY snapshot_stage)"""


@register("typical_fit", O.sql(
    "SELECT 'route_stage' AS level, route, snapshot_stage, typical_route_stage AS typical FROM trs "
    "UNION ALL SELECT 'stage' AS level, CAST(NULL AS VARCHAR) AS route, snapshot_stage, typical_stage AS typical FROM tst",
    _TYP_FIT))
def q_typical_fit(t: Journeys) -> DataFrame:
    rs, st = EN.typical_fit(t.snapshots_of("train"))
    return (rs.select(F.lit("route_stage").alias("level"), "route", "snapshot_stage",
                      F.col("typical_route_stage").alias("typical"))
            .unionByName(st.select(F.lit("stage").alias("level"), F.lit(None).cast("string").alias("route"),
                                   "snapshot_stage", F.col("typical_stage").alias("typical"))))


@register("typical_map", O.sql(
    f"SELECT s.snapshot_id, {O.LATEST('s.')} - coalesce(trs.typical_route_stage, tst.typical_stage) "
    "AS observed_delay_vs_route_typical FROM snaps_s s "
    "LEFT JOIN trs ON trs.route = s.route AND trs.snapshot_stage = s.snapshot_stage "
    "LEFT JOIN tst ON tst.snapshot_stage = s.snapshot_stage WHERE s.split = 'validation'", _TYP_FIT))
def q_typical_map(t: Journeys) -> DataFrame:
    rs, st = EN.typical_fit(t.snapshots_of("train"))
    return EN.map_typical(t.snapshots_of("validation"), rs, st).select(
        "snapshot_id", "observed_delay_vs_route_typical")


def _oof_ctes(salt: str = str(O.SEED)) -> str:
    return f"""
fs AS (SELECT shipment_id, route, final_delay_hours, CAST(final_delay_hours > 12.0 AS DOUBLE) AS m,
              {O.FOLD('shipment_id', salt)} AS fold FROM ship_s WHERE split = 'train'),
holds AS (SELECT CAST(range AS INTEGER) AS hold FROM range(5)),
comp_med AS (SELECT h.hold, f.route, median(f.final_delay_hours) AS v FROM fs f JOIN holds h ON f.fold <> h.hold
             WHERE f.route IS NOT NULL GROUP BY h.hold, f.route),
comp_med_all AS (SELECT h.hold, median(f.final_delay_hours) AS v FROM fs f JOIN holds h ON f.fold <> h.hold GROUP BY h.hold),
comp_rate AS (SELECT h.hold, f.route, avg(f.m) AS v FROM fs f JOIN holds h ON f.fold <> h.hold
              WHERE f.route IS NOT NULL GROUP BY h.hold, f.route),
comp_rate_all AS (SELECT h.hold, avg(f.m) AS v FROM fs f JOIN holds h ON f.fold <> h.hold GROUP BY h.hold),
tr AS (SELECT s.*, {O.FOLD('s.shipment_id', salt)} AS fold FROM snaps_s s WHERE s.split = 'train'),
tlat AS (SELECT tr.*, {O.LATEST('tr.')} AS latest FROM tr),
comp_rs AS (SELECT h.hold, l.route, l.snapshot_stage, median(l.latest) AS v FROM tlat l JOIN holds h ON l.fold <> h.hold
            WHERE l.route IS NOT NULL AND l.snapshot_stage IS NOT NULL GROUP BY h.hold, l.route, l.snapshot_stage),
comp_st AS (SELECT h.hold, l.snapshot_stage, median(l.latest) AS v FROM tlat l JOIN holds h ON l.fold <> h.hold
            WHERE l.snapshot_stage IS NOT NULL GROUP BY h.hold, l.snapshot_stage),
oof AS (
  SELECT tr.snapshot_id,
         coalesce(cm.v, cma.v) AS route_prior_final_delay,
         coalesce(cr.v, cra.v) AS route_material_delay_rate,
         {O.LATEST('tr.')} - coalesce(crs.v, cst.v) AS observed_delay_vs_route_typical
  FROM tr
  LEFT JOIN comp_med cm ON cm.hold = tr.fold AND cm.route = tr.route
  LEFT JOIN comp_med_all cma ON cma.hold = tr.fold
  LEFT JOIN comp_rate cr ON cr.hold = tr.fold AND cr.route = tr.route
  LEFT JOIN comp_rate_all cra ON cra.hold = tr.fold
  LEFT JOIN comp_rs crs ON crs.hold = tr.fold AND crs.route = tr.route AND crs.snapshot_stage = tr.snapshot_stage
  LEFT JOIN comp_st cst ON cst.hold = tr.fold AND cst.snapshot_stage = tr.snapshot_stage)"""


@register("oof_route_median", O.sql("SELECT snapshot_id, route_prior_final_delay FROM oof", _oof_ctes()))
def q_oof_median(t: Journeys) -> DataFrame:
    return EN.oof_route_median(t.snapshots_of("train"), t.shipments_of("train"), t.cfg.folds,
                               t.cfg.fold_salt(0)).select("snapshot_id", "route_prior_final_delay")


@register("oof_route_rate", O.sql("SELECT snapshot_id, round(route_material_delay_rate, 9) AS route_material_delay_rate FROM oof", _oof_ctes()))
def q_oof_rate(t: Journeys) -> DataFrame:
    return EN.oof_route_rate(t.snapshots_of("train"), t.shipments_of("train"), t.cfg.folds,
                             t.cfg.fold_salt(0)).select("snapshot_id", F.round("route_material_delay_rate", 9)
                                                        .alias("route_material_delay_rate"))


@register("oof_typical", O.sql("SELECT snapshot_id, observed_delay_vs_route_typical FROM oof", _oof_ctes()))
def q_oof_typical(t: Journeys) -> DataFrame:
    tr = t.snapshots_of("train")
    return EN.oof_typical(tr, tr, t.cfg.folds, t.cfg.fold_salt(0)).select(
        "snapshot_id", "observed_delay_vs_route_typical")


_ROUTE_FIT = """
rf AS (SELECT route, final_delay_hours, CAST(final_delay_hours > 12.0 AS DOUBLE) AS m FROM ship_s WHERE split IN ({splits})),
rmed AS (SELECT route, median(final_delay_hours) AS v, avg(m) AS rate FROM rf WHERE route IS NOT NULL GROUP BY route),
rall AS (SELECT median(final_delay_hours) AS v, avg(m) AS rate FROM rf)"""


def _route_fit(splits: str) -> str:
    return _ROUTE_FIT.format(splits=splits)


@register("route_prior", O.sql(
    "SELECT s.snapshot_id, coalesce(rmed.v, rall.v) AS route_prior_final_delay FROM snaps_s s "
    "LEFT JOIN rmed ON rmed.route = s.route CROSS JOIN rall WHERE s.split = 'validation'",
    _route_fit("'train'")))
def q_route_prior(t: Journeys) -> DataFrame:
    return EN.route_median(t.shipments_of("train"), t.snapshots_of("validation"),
                           out="route_prior_final_delay").select("snapshot_id", "route_prior_final_delay")


_NULLABLE = ["observed_departure_delay_hours", "observed_port_arrival_delay_hours",
             "observed_customs_delay_hours", "truck_availability_score"]
_IMPUTE_CTES = f"""
bf AS (SELECT snapshot_id, split, {_BASE_SQL} FROM snaps_s),
med AS (SELECT {", ".join(f"median({c}) AS {c}" for c in FE.NUMERIC)} FROM bf WHERE split = 'train')"""


@register("median_impute", O.sql(
    "SELECT bf.snapshot_id, "
    + ", ".join(f"coalesce(bf.{c}, med.{c}) AS {c}" for c in FE.NUMERIC) + ", "
    + ", ".join(f"CAST(bf.{c} IS NULL AS DOUBLE) AS missingindicator_{c}" for c in _NULLABLE)
    + " FROM bf CROSS JOIN med WHERE bf.split = 'validation'", _IMPUTE_CTES))
def q_median_impute(t: Journeys) -> DataFrame:
    prep = FE.fit_preprocessor(FE.base_features(t.snapshots_of("train")), FE.NUMERIC)
    out = prep.imputed(FE.base_features(t.snapshots_of("validation")))
    return out.select("snapshot_id", *prep.numeric, *[f"missingindicator_{c}" for c in prep.indicators])


@register("mode_impute", O.sql(
    "SELECT col, level, n, row_number() OVER (PARTITION BY col ORDER BY n DESC, level) = 1 AS is_mode FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS level, CAST(count(*) AS BIGINT) AS n "
                         f"FROM bf WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c}"
                         for c in FE.CATEGORICAL) + ")", _IMPUTE_CTES))
def q_mode_impute(t: Journeys) -> DataFrame:
    from pyspark.sql import Window
    bf = FE.base_features(t.snapshots_of("train"))
    parts = [FE.mode_table(bf, c).select(F.lit(c).alias("col"), F.col(c).cast("string").alias("level"),
                                         F.col("n").cast("bigint").alias("n")) for c in FE.CATEGORICAL]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    w = Window.partitionBy("col").orderBy(F.col("n").desc(), F.col("level"))  # <= levels per column
    return u.withColumn("is_mode", F.row_number().over(w) == 1)


# categories are missing where a score is low, so that the fill is used
_GAPS = {"route_id": ("weather_severity", 0.3), "carrier": ("congestion_score", 0.4), "snapshot_stage": ("weather_severity", 0.1)}
_GAPPED = ", ".join(f"CASE WHEN {g} >= {x} THEN {c} END AS {c}" for c, (g, x) in _GAPS.items())


@register("mode_impute_fitted", O.sql(
    "SELECT snapshot_id, " + ", ".join(f"coalesce({c}, (SELECT level FROM mode_of WHERE col = '{c}')) AS {c}" for c in _GAPS)
    + " FROM gapped WHERE split = 'validation'",
    _IMPUTE_CTES + f""",
gapped AS (SELECT snapshot_id, split, {_GAPPED} FROM bf),
level_n AS (""" + " UNION ALL ".join(
        f"SELECT '{c}' AS col, {c} AS level, count(*) AS n FROM gapped WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c}"
        for c in _GAPS) + """),
mode_of AS (SELECT col, level FROM (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, level) AS r FROM level_n) WHERE r = 1)"""))
def q_mode_impute_fitted(t: Journeys) -> DataFrame:
    """F13 by the preprocessor that the models use: fitted on train, applied to validation."""
    def gapped(split: str) -> DataFrame:
        return FE.base_features(t.snapshots_of(split)).withColumns(
            {c: F.when(F.col(g) >= x, F.col(c)) for c, (g, x) in _GAPS.items()})

    fitted = FE.fit_preprocessor(gapped("train"), FE.CATEGORICAL)
    return fitted.imputed(gapped("validation")).select("snapshot_id", *FE.CATEGORICAL)


# Category levels of the TPC-H-derived test data (route = region
# name, carrier = order priority) used to spell out the one-hot oracle.
_LEVELS = {
    "route_id": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "carrier": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "snapshot_stage": ["CUSTOMS_CLEARED", "ORIGIN_DEPARTED", "PORT_ARRIVED"],
}


@register("one_hot", O.sql(
    "SELECT snapshot_id, " + ", ".join(
        f"CAST({c} = '{v}' AS DOUBLE) AS {c}_{FE.level_name(v)}" for c, vs in _LEVELS.items() for v in vs)
    + " FROM bf WHERE split = 'validation'", _IMPUTE_CTES))
def q_one_hot(t: Journeys) -> DataFrame:
    prep = FE.fit_preprocessor(FE.base_features(t.snapshots_of("train")), FE.CATEGORICAL)
    out = prep.one_hot(FE.base_features(t.snapshots_of("validation")))
    return out.select("snapshot_id", *prep.input_columns())


@register("risk_feature_frame", O.sql(
    f"SELECT tr.snapshot_id, tr.route AS route_id, tr.carrier, tr.snapshot_stage, "
    f"{O.EXACT_HOURS(_START.replace('snapshot_stage', 'tr.snapshot_stage'), 'tr.scheduled_final_eta')} AS planned_remaining_hours, "
    f"{_DOW.replace('snapshot_stage', 'tr.snapshot_stage')} AS arrival_day_of_week, "
    "tr.observed_departure_delay_hours, tr.observed_port_arrival_delay_hours, tr.observed_customs_delay_hours, "
    "tr.congestion_score, tr.weather_severity, tr.document_readiness_score, tr.truck_availability_score, "
    "tr.event_completeness_score, "
    "tr.observed_port_arrival_delay_hours * tr.congestion_score AS port_delay_x_congestion, "
    "tr.observed_port_arrival_delay_hours * (1 - tr.document_readiness_score) AS port_delay_x_document_gap, "
    "tr.observed_customs_delay_hours * (1 - tr.truck_availability_score) AS customs_delay_x_truck_shortage, "
    "oof.observed_delay_vs_route_typical, round(oof.route_material_delay_rate, 9) AS route_material_delay_rate, "
    "oof.route_prior_final_delay AS stage_routed_predicted_final_delay_hours, "
    "oof.route_prior_final_delay - 12.0 AS delay_margin_to_material_threshold "
    "FROM tr JOIN oof USING (snapshot_id)", _oof_ctes()))
def q_risk_frame(t: Journeys) -> DataFrame:
    """F15 with the OOF route prior standing in for the routed ETA column."""
    t = t.materialize()  # three fits and the rows themselves
    tr, ts, k, salt = t.snapshots_of("train"), t.shipments_of("train"), t.cfg.folds, t.cfg.fold_salt(0)
    # every row is one of the fitted shipments': none has to be looked up
    r = EN.oof_typical(tr.withColumn("_is_member", F.lit(True)), tr, k, salt, member_col="_is_member")
    r = EN.oof_route_rate(r, ts, k, salt, member_col="_is_member")
    r = EN.oof_route_median(r, ts, k, salt, out="stage_routed_predicted_final_delay_hours", member_col="_is_member")
    out = FE.risk_feature_frame(r)
    return out.withColumn("route_material_delay_rate", F.round("route_material_delay_rate", 9))


# ---------------------------------------------------------------- G0-G2, J1-J6
from milepost.operators import baselines as BL  # noqa: E402
from milepost.operators import evaluate as EV  # noqa: E402
from milepost.operators import risk as RK  # noqa: E402

_FINAL = _route_fit("'train', 'validation'") + f""",
te AS (SELECT s.*, coalesce(rmed.v, rall.v) AS b1, coalesce(rmed.rate, rall.rate) AS p,
              {O.LATEST('s.')} AS b2
       FROM snaps_s s LEFT JOIN rmed ON rmed.route = s.route CROSS JOIN rall WHERE s.split = 'test'),
long AS (
  SELECT 'B0 Scheduled ETA' AS method, 0 AS mo, snapshot_stage, target_final_delay_hours AS y, 0.0 AS pr FROM te
  UNION ALL SELECT 'B1 Route median', 1, snapshot_stage, target_final_delay_hours, b1 FROM te
  UNION ALL SELECT 'B2 Latest observed carry-forward', 2, snapshot_stage, target_final_delay_hours, b2 FROM te),
scoped AS (
  SELECT method, mo, 'ALL' AS scope, 0 AS so, y, pr FROM long WHERE pr IS NOT NULL
  UNION ALL SELECT method, mo, snapshot_stage, CASE snapshot_stage WHEN 'ORIGIN_DEPARTED' THEN 1 WHEN 'PORT_ARRIVED' THEN 2 ELSE 3 END, y, pr
  FROM long WHERE pr IS NOT NULL),
regm AS (
  SELECT method, scope, CAST(count(*) AS BIGINT) AS n_snapshots, avg(abs(pr - y)) AS mae_hours,
         sqrt(avg((pr - y) * (pr - y))) AS rmse_hours, min(mo) AS mo, min(so) AS so
  FROM scoped GROUP BY method, scope),
rs AS (
  SELECT 'ALL' AS scope, p, target_is_materially_delayed AS y FROM te
  UNION ALL SELECT snapshot_stage, p, target_is_materially_delayed FROM te),
cls AS (
  SELECT scope, CAST(count(*) AS BIGINT) AS n_snapshots,
         sum(CASE WHEN p >= 0.29 AND y = 1 THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN p >= 0.29 AND y = 0 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN NOT coalesce(p >= 0.29, false) AND y = 1 THEN 1 ELSE 0 END) AS fn,
         avg((p - y) * (p - y)) AS brier_score
  FROM rs GROUP BY scope),
prf AS (
  SELECT scope, n_snapshots,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1,
         brier_score FROM cls),
ps AS (SELECT scope, p, sum(y) AS tp, count(*) AS n FROM rs GROUP BY scope, p),
cum AS (SELECT scope, p, tp, sum(tp) OVER (PARTITION BY scope ORDER BY p DESC) AS ctp,
               sum(n) OVER (PARTITION BY scope ORDER BY p DESC) AS cn FROM ps),
ap AS (SELECT scope, CASE WHEN sum(tp) > 0 THEN sum(tp * (CAST(ctp AS DOUBLE) / cn)) / sum(tp) END AS pr_auc
       FROM cum GROUP BY scope)"""


def _final_rows(t: Journeys) -> DataFrame:
    """Test rows with B0/B1/B2 (fit: train + validation) and a deterministic
    score: the full-fit route material-delay rate (I1).  The legs are joined and written
    once: two fits, the test rows and every metric on them read them again."""
    t = t.materialize()
    fit = t.shipments_of("train", "validation")
    rows = BL.all_baselines(fit, t.snapshots_of("test"))
    return EN.route_rate(fit, rows, out="risk_probability")


_BASELINES = {"B0 Scheduled ETA": "b0_predicted_delay_hours",
              "B1 Route median": "b1_predicted_delay_hours",
              "B2 Latest observed carry-forward": "b2_predicted_delay_hours"}


@register("baseline_scheduled", O.sql("SELECT snapshot_id, 0.0 AS b0_predicted_delay_hours FROM te", _FINAL))
def q_b0(t: Journeys) -> DataFrame:
    return BL.scheduled(t.snapshots_of("test")).select("snapshot_id", "b0_predicted_delay_hours")


@register("baseline_route_median", O.sql("SELECT snapshot_id, b1 AS b1_predicted_delay_hours FROM te", _FINAL))
def q_b1(t: Journeys) -> DataFrame:
    return BL.route_median_baseline(t.shipments_of("train", "validation"), t.snapshots_of("test")).select(
        "snapshot_id", "b1_predicted_delay_hours")


@register("baseline_carry", O.sql("SELECT snapshot_id, b2 AS b2_predicted_delay_hours FROM te", _FINAL))
def q_b2(t: Journeys) -> DataFrame:
    return BL.carry_forward(t.snapshots_of("test")).select("snapshot_id", "b2_predicted_delay_hours")


@register("baseline_regression_metrics", O.sql(
    "SELECT method, scope, n_snapshots, round(mae_hours, 6) AS mae_hours, round(rmse_hours, 6) AS rmse_hours FROM regm",
    _FINAL))
def q_regression(t: Journeys) -> DataFrame:
    m = EV.regression_metrics(_final_rows(t), _BASELINES)
    return m.select("method", "scope", "n_snapshots", r6("mae_hours").alias("mae_hours"),
                    r6("rmse_hours").alias("rmse_hours"))


@register("precision_recall_f1", O.sql(
    "SELECT scope, n_snapshots, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1 FROM prf", _FINAL))
def q_prf(t: Journeys) -> DataFrame:
    m = EV.precision_recall_f1(_final_rows(t))
    return m.select("scope", "n_snapshots", r6("precision").alias("precision"),
                    r6("recall").alias("recall"), r6("f1").alias("f1"))


@register("average_precision", O.sql("SELECT scope, round(pr_auc, 6) AS pr_auc FROM ap", _FINAL))
def q_ap(t: Journeys) -> DataFrame:
    return EV.average_precision(_final_rows(t)).select("scope", r6("pr_auc").alias("pr_auc"))


@register("brier", O.sql("SELECT scope, round(brier_score, 6) AS brier_score FROM prf", _FINAL))
def q_brier(t: Journeys) -> DataFrame:
    return EV.precision_recall_f1(_final_rows(t)).select("scope", r6("brier_score").alias("brier_score"))


@register("risk_metrics", O.sql(
    "SELECT 'Risk HGB v2 Stack' AS method, 0.29 AS threshold, prf.n_snapshots, round(prf.precision, 6) AS precision, "
    "round(prf.recall, 6) AS recall, round(prf.f1, 6) AS f1, round(ap.pr_auc, 6) AS pr_auc, "
    "round(prf.brier_score, 6) AS brier_score, prf.scope FROM prf JOIN ap USING (scope)", _FINAL))
def q_risk_metrics(t: Journeys) -> DataFrame:
    m = EV.risk_metrics(_final_rows(t))
    return m.select("method", "threshold", "n_snapshots", *[r6(c).alias(c) for c in
                    ("precision", "recall", "f1", "pr_auc", "brier_score")], "scope")


_CAL_EDGES = EV.CALIBRATION_EDGES


@register("calibration_table", O.sql(
    "SELECT b.bin, CAST(count(te.p) AS BIGINT) AS n, round(avg(te.p), 6) AS mean_predicted_probability, "
    "round(avg(CAST(te.target_is_materially_delayed AS DOUBLE)), 6) AS observed_material_delay_rate "
    "FROM (VALUES " + ", ".join(
        f"('{lab}', {_CAL_EDGES[i]!r}, {_CAL_EDGES[i + 1]!r}, {i})" for i, lab in enumerate(EV.CALIBRATION_LABELS))
    + ") b(bin, lo, hi, i) LEFT JOIN te ON (te.p > b.lo OR (b.i = 0 AND te.p >= b.lo)) AND te.p <= b.hi "
    "GROUP BY b.bin", _FINAL))
def q_calibration(t: Journeys) -> DataFrame:
    c = EV.calibration_table(_final_rows(t))
    return c.select("bin", "n", r6("mean_predicted_probability").alias("mean_predicted_probability"),
                    r6("observed_material_delay_rate").alias("observed_material_delay_rate"))


@register("test_counts_by_stage", O.sql(
    "SELECT snapshot_stage, CAST(count(*) AS BIGINT) AS n_snapshots FROM te GROUP BY snapshot_stage", _FINAL))
def q_counts_by_stage(t: Journeys) -> DataFrame:
    return EV.counts_by_stage(t.snapshots_of("test"))


@register("risk_level", O.sql(
    "SELECT snapshot_id, CASE WHEN p > -0.01 AND p <= 0.35 THEN 'LOW' WHEN p > 0.35 AND p <= 0.65 THEN 'MEDIUM' "
    "WHEN p > 0.65 AND p <= 1.0 THEN 'HIGH' END AS risk_level FROM te", _FINAL))
def q_risk_level(t: Journeys) -> DataFrame:
    return _final_rows(t).select("snapshot_id", RK.risk_level().alias("risk_level"))


@register("risk_alert", O.sql(
    "SELECT snapshot_id, coalesce(p >= 0.29, false) AS predicted_material_delay FROM te", _FINAL))
def q_risk_alert(t: Journeys) -> DataFrame:
    return _final_rows(t).select("snapshot_id", RK.risk_alert().alias("predicted_material_delay"))


# ---------------------------------------------------------------- H (non-model parts)
from milepost.operators import eta as ET  # noqa: E402

_S2S3 = f"""
truth AS (SELECT shipment_id, actual_customs_clearance_at AS ac, actual_final_delivery_at AS af FROM ship_s WHERE split = 'train'),
s2 AS (SELECT s.snapshot_id, s.snapshot_at, s.scheduled_final_eta,
         {O.EXACT_HOURS('s.snapshot_at', 's.scheduled_customs_clearance_at')} AS planned_customs_remaining_hours,
         {O.EXACT_HOURS('s.scheduled_customs_clearance_at', 's.scheduled_final_eta')} AS planned_post_customs_remaining_hours,
         {O.EXACT_HOURS('s.snapshot_at', 't.ac')} - {O.EXACT_HOURS('s.snapshot_at', 's.scheduled_customs_clearance_at')} AS customs_deviation_hours,
         {O.EXACT_HOURS('t.ac', 't.af')} - {O.EXACT_HOURS('s.scheduled_customs_clearance_at', 's.scheduled_final_eta')} AS post_customs_deviation_hours
       FROM snaps_s s LEFT JOIN truth t USING (shipment_id) WHERE s.split = 'train' AND s.snapshot_stage = 'PORT_ARRIVED'),
s3 AS (SELECT s.snapshot_id, s.snapshot_at, s.scheduled_final_eta,
         {O.EXACT_HOURS('s.snapshot_at', 's.scheduled_final_eta')} AS planned_inland_remaining_hours,
         {O.EXACT_HOURS('s.snapshot_at', 't.af')} - {O.EXACT_HOURS('s.snapshot_at', 's.scheduled_final_eta')} AS inland_deviation_hours
       FROM snaps_s s LEFT JOIN truth t USING (shipment_id) WHERE s.split = 'train' AND s.snapshot_stage = 'CUSTOMS_CLEARED')"""


@register("s2_targets", O.sql(
    "SELECT snapshot_id, planned_customs_remaining_hours, planned_post_customs_remaining_hours, "
    "customs_deviation_hours, post_customs_deviation_hours FROM s2", _S2S3))
def q_s2(t: Journeys) -> DataFrame:
    tr = t.snapshots_of("train").where(F.col("snapshot_stage") == "PORT_ARRIVED")
    return ET.s2_targets(tr, t.shipments_of("train")).select(
        "snapshot_id", "planned_customs_remaining_hours", "planned_post_customs_remaining_hours",
        "customs_deviation_hours", "post_customs_deviation_hours")


@register("s3_targets", O.sql(
    "SELECT snapshot_id, planned_inland_remaining_hours, inland_deviation_hours FROM s3", _S2S3))
def q_s3(t: Journeys) -> DataFrame:
    tr = t.snapshots_of("train").where(F.col("snapshot_stage") == "CUSTOMS_CLEARED")
    return ET.s3_targets(tr, t.shipments_of("train")).select(
        "snapshot_id", "planned_inland_remaining_hours", "inland_deviation_hours")


@register("waterfall_identity", O.sql(
    "SELECT snapshot_id, round(" + O.EXACT_HOURS("scheduled_final_eta", O.ADD_HOURS(
        "snapshot_at", "planned_customs_remaining_hours + customs_deviation_hours + "
        "planned_post_customs_remaining_hours + post_customs_deviation_hours")) + ", 6) AS structured_delay_hours FROM s2 "
    "UNION ALL SELECT snapshot_id, round(" + O.EXACT_HOURS("scheduled_final_eta", O.ADD_HOURS(
        "snapshot_at", "planned_inland_remaining_hours + inland_deviation_hours")) + ", 6) FROM s3", _S2S3))
def q_waterfall(t: Journeys) -> DataFrame:
    """H6/H7 fed with the true deviations: reproduces the final delay."""
    tr, truth = t.snapshots_of("train"), t.shipments_of("train")
    s2 = ET.s2_targets(tr.where(F.col("snapshot_stage") == "PORT_ARRIVED"), truth)
    s3 = ET.s3_targets(tr.where(F.col("snapshot_stage") == "CUSTOMS_CLEARED"), truth)
    a = s2.select("snapshot_id", r6(ET.waterfall_s2(
        F.col("planned_customs_remaining_hours"), F.col("customs_deviation_hours"),
        F.col("planned_post_customs_remaining_hours"), F.col("post_customs_deviation_hours")))
        .alias("structured_delay_hours"))
    b = s3.select("snapshot_id", r6(ET.waterfall_s3(
        F.col("planned_inland_remaining_hours"), F.col("inland_deviation_hours"))).alias("structured_delay_hours"))
    return a.unionByName(b)


@register("stage_routing", O.sql(
    "SELECT snapshot_id, CASE snapshot_stage WHEN 'ORIGIN_DEPARTED' THEN 'Direct HGB v2' "
    "WHEN 'PORT_ARRIVED' THEN 'Structured HGB v2' WHEN 'CUSTOMS_CLEARED' THEN 'Structured HGB v2' END "
    "AS selected_eta_model FROM snaps"))
def q_routing(t: Journeys) -> DataFrame:
    return t.snapshots.select("snapshot_id", ET.route_policy(t.cfg.eta_policy).alias("selected_eta_model"))


@register("predicted_eta", O.sql(
    f"SELECT snapshot_id, {O.ISO(O.ADD_HOURS('scheduled_final_eta', 'b1'))} AS predicted_final_eta FROM te", _FINAL))
def q_predicted_eta(t: Journeys) -> DataFrame:
    """H9 on a deterministic delay column (the B1 route median)."""
    rows = BL.route_median_baseline(t.shipments_of("train", "validation"), t.snapshots_of("test"),
                                    out="predicted_final_delay_hours")
    return rows.select("snapshot_id", ET.predicted_eta().alias("predicted_final_eta"))


# ---------------------------------------------------------------- K1-K13
from milepost.operators import profile as PR  # noqa: E402


@register("eda_snapshot_counts", O.sql(
    "SELECT d.snapshot_stage, CAST(count(s.snapshot_id) AS BIGINT) AS snapshots FROM (VALUES ('ORIGIN_DEPARTED'), "
    "('PORT_ARRIVED'), ('CUSTOMS_CLEARED')) d(snapshot_stage) LEFT JOIN snaps s USING (snapshot_stage) GROUP BY d.snapshot_stage"))
def q_eda_k1(t: Journeys) -> DataFrame:
    return PR.snapshot_counts_by_stage(t.snapshots)


@register("eda_route_counts", O.sql("SELECT route, CAST(count(*) AS BIGINT) AS shipments FROM shipments_t GROUP BY route"))
def q_eda_k2(t: Journeys) -> DataFrame:
    return PR.counts_by(t.shipments, "route")


@register("eda_carrier_counts", O.sql("SELECT carrier, CAST(count(*) AS BIGINT) AS shipments FROM shipments_t GROUP BY carrier"))
def q_eda_k3(t: Journeys) -> DataFrame:
    return PR.counts_by(t.shipments, "carrier")


@register("eda_planned_duration", O.sql(
    "SELECT route, median(planned_ocean_hours) AS planned_ocean_hours, median(planned_customs_hours) AS planned_customs_hours, "
    "median(planned_inland_hours) AS planned_inland_hours FROM shipments_t GROUP BY route"))
def q_eda_k4(t: Journeys) -> DataFrame:
    return PR.planned_duration_by_route(t.shipments)


@register("eda_route_delay", O.sql(
    "SELECT route, CAST(count(*) AS BIGINT) AS shipments, round(avg(CAST(final_delay_hours > 12.0 AS DOUBLE)), 6) AS material_delay_rate, "
    "median(final_delay_hours) AS median_final_delay_hours FROM shipments_t GROUP BY route"))
def q_eda_k5(t: Journeys) -> DataFrame:
    return PR.route_delay(t.shipments).withColumn("material_delay_rate", r6("material_delay_rate"))


@register("eda_delay_buckets", O.sql(
    "SELECT d.bucket, CAST(count(x.b) AS BIGINT) AS shipments FROM (VALUES ('early_or_on_time'), ('1_to_6h'), "
    "('6_to_12h'), ('over_12h')) d(bucket) LEFT JOIN (SELECT CASE WHEN final_delay_hours <= 0 THEN 'early_or_on_time' "
    "WHEN final_delay_hours <= 6 THEN '1_to_6h' WHEN final_delay_hours <= 12 THEN '6_to_12h' "
    "WHEN final_delay_hours > 12 THEN 'over_12h' END AS b FROM shipments_t) x ON x.b = d.bucket GROUP BY d.bucket"))
def q_eda_k6(t: Journeys) -> DataFrame:
    return PR.delay_buckets(t.shipments)


@register("eda_delay_distribution", O.sql(
    "SELECT round(avg(final_delay_hours), 6) AS mean_final_delay_hours, median(final_delay_hours) AS median_final_delay_hours, "
    "round(stddev_samp(final_delay_hours), 6) AS std_final_delay_hours FROM shipments_t"))
def q_eda_k7(t: Journeys) -> DataFrame:
    d = PR.delay_distribution(t.shipments)
    return d.select(r6("mean_final_delay_hours").alias("mean_final_delay_hours"), "median_final_delay_hours",
                    r6("std_final_delay_hours").alias("std_final_delay_hours"))


@register("eda_propagation", O.sql(
    "SELECT 'port_delay_to_customs_increment' AS relation, round(corr(port_arrival_delay_hours, customs_incremental_delay_hours), 6) AS correlation FROM shipments_t "
    "UNION ALL SELECT 'customs_increment_to_inland_increment', round(corr(customs_incremental_delay_hours, inland_incremental_delay_hours), 6) FROM shipments_t "
    "UNION ALL SELECT 'port_delay_to_final_delay', round(corr(port_arrival_delay_hours, final_delay_hours), 6) FROM shipments_t"))
def q_eda_k8(t: Journeys) -> DataFrame:
    return PR.propagation(t.shipments).withColumn("correlation", r6("correlation"))


@register("eda_update_quality", O.sql(
    "SELECT milestone, CAST(count(*) AS BIGINT) AS events, round(avg(CAST(is_update_missing AS DOUBLE)), 6) AS missing_update_rate, "
    "round(avg(CAST(is_late_update AS DOUBLE)), 6) AS late_update_rate FROM mevents GROUP BY milestone"))
def q_eda_k9(t: Journeys) -> DataFrame:
    q = PR.update_quality(t.events)
    return q.select("milestone", "events", r6("missing_update_rate").alias("missing_update_rate"),
                    r6("late_update_rate").alias("late_update_rate"))


@register("eda_feature_availability", O.sql(
    "SELECT snapshot_stage, " + ", ".join(
        f"round(avg(CAST({c} IS NOT NULL AS DOUBLE)), 6) AS {c}" for c in PR.AVAILABILITY)
    + " FROM snaps GROUP BY snapshot_stage"))
def q_eda_k10(t: Journeys) -> DataFrame:
    a = PR.feature_availability(t.snapshots)
    return a.select("snapshot_stage", *[r6(c).alias(c) for c in PR.AVAILABILITY])


@register("eda_mean_delay_by_route", O.sql(
    "SELECT route, round(avg(final_delay_hours), 6) AS mean_final_delay_hours FROM shipments_t GROUP BY route"))
def q_eda_k11(t: Journeys) -> DataFrame:
    return PR.mean_delay_by_route(t.shipments).withColumn("mean_final_delay_hours", r6("mean_final_delay_hours"))


@register("eda_delay_histogram", O.sql(
    "SELECT b.bin, round(r.lo + b.bin * (r.hi - r.lo) / 20.0, 6) AS bin_start, "
    "round(r.lo + (b.bin + 1) * (r.hi - r.lo) / 20.0, 6) AS bin_end, CAST(count(x.bin) AS BIGINT) AS shipments "
    "FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) b CROSS JOIN r "
    "LEFT JOIN (SELECT CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((s.final_delay_hours - r.lo) / ((r.hi - r.lo) / 20.0)), 19) END AS INTEGER) AS bin "
    "FROM shipments_t s CROSS JOIN r WHERE s.final_delay_hours IS NOT NULL) x ON x.bin = b.bin "
    "GROUP BY b.bin, r.lo, r.hi",
    "r AS (SELECT min(final_delay_hours) AS lo, max(final_delay_hours) AS hi FROM shipments_t)"))
def q_eda_k12(t: Journeys) -> DataFrame:
    h = PR.delay_histogram(t.shipments)
    return h.select("bin", r6("bin_start").alias("bin_start"), r6("bin_end").alias("bin_end"), "shipments")


@register("eda_propagation_points", O.sql(
    "SELECT shipment_id, port_arrival_delay_hours, customs_incremental_delay_hours, inland_incremental_delay_hours, "
    "final_delay_hours FROM shipments_t"))
def q_eda_k13(t: Journeys) -> DataFrame:
    return PR.propagation_points(t.shipments)


# ---------------------------------------------------------------- L1-L9
from milepost.operators import report as RP  # noqa: E402


@register("case_s1", O.sql(
    "SELECT snapshot_id, shipment_id, route, snapshot_stage, p AS risk_probability FROM te "
    "WHERE snapshot_stage = 'ORIGIN_DEPARTED' ORDER BY p DESC NULLS LAST, snapshot_id LIMIT 1", _FINAL))
def q_case_s1(t: Journeys) -> DataFrame:
    return RP.case_s1_highest_risk(_final_rows(t)).select(
        "snapshot_id", "shipment_id", "route", "snapshot_stage", "risk_probability")


@register("case_s3", O.sql(
    "SELECT snapshot_id, shipment_id, route, snapshot_stage, p AS risk_probability FROM te "
    "WHERE snapshot_stage = 'CUSTOMS_CLEARED' ORDER BY p ASC NULLS LAST, snapshot_id LIMIT 1", _FINAL))
def q_case_s3(t: Journeys) -> DataFrame:
    return RP.case_s3_lowest_risk(_final_rows(t)).select(
        "snapshot_id", "shipment_id", "route", "snapshot_stage", "risk_probability")


@register("case_s2", O.sql(
    "SELECT snapshot_id, round(customs_deviation_hours + post_customs_deviation_hours, 6) AS total_deviation_hours FROM s2 "
    "ORDER BY customs_deviation_hours + post_customs_deviation_hours DESC NULLS LAST, snapshot_id LIMIT 1", _S2S3))
def q_case_s2(t: Journeys) -> DataFrame:
    """L2 ranking fed with the true deviations of the fit rows."""
    tr = t.snapshots_of("train").where(F.col("snapshot_stage") == "PORT_ARRIVED")
    s2 = ET.s2_targets(tr, t.shipments_of("train"))
    top = RP.case_s2_highest_deviation(s2, "customs_deviation_hours", "post_customs_deviation_hours")
    return top.select("snapshot_id", r6(F.col("customs_deviation_hours") + F.col("post_customs_deviation_hours"))
                      .alias("total_deviation_hours"))


_REC_SQL = (
    "coalesce(nullif(concat_ws(' | ', CASE WHEN p >= 0.29 THEN '" + RP.ESCALATE + "' END, "
    "CASE WHEN coalesce(document_readiness_score, 1.0) < 0.6 THEN '" + RP.DOCUMENTS + "' END, "
    "CASE WHEN coalesce(event_completeness_score, 1.0) < 1.0 THEN '" + RP.REQUEST_UPDATE + "' END), ''), '"
    + RP.CONTINUE + "')")


@register("recommendations", O.sql(f"SELECT snapshot_id, {_REC_SQL} AS recommendations FROM te", _FINAL))
def q_recommendations(t: Journeys) -> DataFrame:
    return _final_rows(t).select("snapshot_id", F.array_join(RP.recommendations(), " | ").alias("recommendations"))


@register("quality_counts", O.sql(
    "SELECT (SELECT CAST(count(*) AS BIGINT) FROM shipments_t) AS shipments, (SELECT CAST(count(*) AS BIGINT) FROM mevents) AS events, "
    "(SELECT CAST(count(*) AS BIGINT) FROM snaps) AS snapshots, "
    "(SELECT CASE WHEN max(violations) = 0 THEN 'passed' ELSE 'failed' END FROM (\n  "
    + _RULE_ROWS.format(**_rule_sql("shipments_t", "mevents", "snaps")) + ")) AS verdict"))
def q_quality_counts(t: Journeys) -> DataFrame:
    rep = quality.quality_report(t.shipments, t.events, t.snapshots)
    return RP.quality_counts(t.shipments, t.events, t.snapshots, rep)


@register("report_metrics", O.sql(
    "SELECT method, scope, n_snapshots, round(mae_hours, 3) AS mae_hours, round(rmse_hours, 3) AS rmse_hours FROM regm", _FINAL))
def q_report_metrics(t: Journeys) -> DataFrame:
    return RP.report_metrics(EV.regression_metrics(_final_rows(t), _BASELINES))


@register("risk_by_stage", O.sql(
    "SELECT snapshot_stage, round(avg(p), 6) AS mean_risk_probability FROM te GROUP BY snapshot_stage", _FINAL))
def q_risk_by_stage(t: Journeys) -> DataFrame:
    return RP.risk_by_stage(_final_rows(t)).withColumn("mean_risk_probability", r6("mean_risk_probability"))


@register("mae_by_method", O.sql("SELECT method, round(mae_hours, 6) AS mae_hours FROM regm WHERE scope = 'ALL'", _FINAL))
def q_mae_by_method(t: Journeys) -> DataFrame:
    return RP.mae_by_method(EV.regression_metrics(_final_rows(t), _BASELINES)).withColumn("mae_hours", r6("mae_hours"))


# ---------------------------------------------------------------- H/I model fits (rows-only checks)
# Boosted-tree fits have no SQL equivalent; the driver records row counts.


@register("eta_predictions")
def q_eta_predictions(t: Journeys) -> DataFrame:
    """H1-H9: fit on train, predict validation (full learner settings)."""
    t = t.materialize()  # the fits read the rows many times
    _, pred = ET.fit_eta(t.snapshots_of("train"), t.shipments_of("train"), t.snapshots_of("validation"), t.cfg)
    return pred.select("snapshot_id", "snapshot_stage", *ET.ETA_COLUMNS)


@register("eta_oof")
def q_eta_oof(t: Journeys) -> DataFrame:
    """Cross-fitted ETA over the train split (20 fits, full learner settings)."""
    t = t.materialize()
    return ET.eta_oof(t.snapshots_of("train"), t.shipments_of("train"), t.cfg)


@register("risk_predictions")
def q_risk_predictions(t: Journeys) -> DataFrame:
    """Stacked calibrated risk, fit on train, scored on validation (30 fits,
    full learner settings)."""
    t = t.materialize()
    from milepost.session import cut_lineage
    tr, ts, va = (cut_lineage(t.snapshots_of("train")), cut_lineage(t.shipments_of("train")),
                  cut_lineage(t.snapshots_of("validation")))
    eta_pred, store = RK.eta_with_folds(tr, ts, va, t.cfg)
    _, pred = RK.fit_risk_stack(tr, ts, va, cut_lineage(eta_pred), t.cfg, store=store)
    return pred.select("snapshot_id", "snapshot_stage", "predicted_final_delay_hours", *RK.RISK_OUTPUT)


# ---------------------------------------------------------------- further rows of H-J, L
# Deterministic stand-ins for model outputs: a direct and a structured delay, and
# a score with as many values as rows (ties, buckets and all bins are used).
_WEATHER_P = "(coalesce(rmed.rate, rall.rate) + s.weather_severity) / 2 AS p"
_SCORED = _FINAL.replace("coalesce(rmed.rate, rall.rate) AS p", _WEATHER_P) + """,
te6 AS (SELECT *, (b1 + b2) / 2 AS direct,
               CASE WHEN snapshot_stage <> 'ORIGIN_DEPARTED' THEN b1 * 0.25 + b2 * 0.75 END AS structured FROM te),
long6 AS (
  SELECT method, snapshot_stage, y, pr FROM long
  UNION ALL SELECT 'Direct HGB v2', snapshot_stage, target_final_delay_hours, direct FROM te6
  UNION ALL SELECT 'Structured HGB v2', snapshot_stage, target_final_delay_hours, structured FROM te6
  UNION ALL SELECT 'Stage-routed v2 policy', snapshot_stage, target_final_delay_hours,
                   CASE WHEN snapshot_stage = 'ORIGIN_DEPARTED' THEN direct ELSE structured END FROM te6),
reg6 AS (
  SELECT method, coalesce(snapshot_stage, 'ALL') AS scope, CAST(count(*) AS BIGINT) AS n_snapshots,
         avg(abs(pr - y)) AS mae_hours, sqrt(avg((pr - y) * (pr - y))) AS rmse_hours
  FROM long6 WHERE pr IS NOT NULL GROUP BY GROUPING SETS ((method), (method, snapshot_stage)))"""


def _scored_rows(t: Journeys) -> DataFrame:
    b1, b2 = F.col("b1_predicted_delay_hours"), F.col("b2_predicted_delay_hours")
    rows = _final_rows(t).withColumns({
        "risk_probability": (F.col("risk_probability") + F.col("weather_severity")) / 2,
        "direct": (b1 + b2) / 2,
        "structured": F.when(F.col("snapshot_stage") != ET.S1, b1 * 0.25 + b2 * 0.75)})
    return rows.withColumn("routed", ET.routed_delay("direct", "structured", t.cfg.eta_policy))


_ALL_METHODS = _BASELINES | {"Direct HGB v2": "direct", "Structured HGB v2": "structured",
                             "Stage-routed v2 policy": "routed"}


@register("regression_metrics_all_methods", O.sql(
    "SELECT method, scope, n_snapshots, round(mae_hours, 6) AS mae_hours, round(rmse_hours, 6) AS rmse_hours FROM reg6",
    _SCORED))
def q_all_methods(t: Journeys) -> DataFrame:
    m = EV.regression_metrics(_scored_rows(t), _ALL_METHODS)
    return m.withColumns({"mae_hours": r6("mae_hours"), "rmse_hours": r6("rmse_hours")})


@register("risk_metrics_continuous", O.sql(
    "SELECT prf.scope, prf.n_snapshots, round(prf.precision, 6) AS precision, round(prf.recall, 6) AS recall, "
    "round(prf.f1, 6) AS f1, round(ap.pr_auc, 6) AS pr_auc, round(prf.brier_score, 6) AS brier_score "
    "FROM prf JOIN ap USING (scope)", _SCORED))
def q_risk_metrics_continuous(t: Journeys) -> DataFrame:
    m = EV.risk_metrics(_scored_rows(t))
    return m.select("scope", "n_snapshots", *[r6(c).alias(c) for c in
                    ("precision", "recall", "f1", "pr_auc", "brier_score")])


@register("calibration_continuous", REGISTRY["calibration_table"].sql.replace(
    "coalesce(rmed.rate, rall.rate) AS p", _WEATHER_P))
def q_calibration_continuous(t: Journeys) -> DataFrame:
    c = EV.calibration_table(_scored_rows(t))
    return c.select("bin", "n", r6("mean_predicted_probability").alias("mean_predicted_probability"),
                    r6("observed_material_delay_rate").alias("observed_material_delay_rate"))


@register("headline_metrics", O.sql(
    "SELECT round(r.mae_hours, 6) AS eta_mae_hours, round(r.rmse_hours, 6) AS eta_rmse_hours, "
    "round(ap.pr_auc, 6) AS risk_pr_auc, round(prf.brier_score, 6) AS risk_brier_score, round(prf.f1, 6) AS risk_f1 "
    "FROM reg6 r JOIN prf USING (scope) JOIN ap USING (scope) "
    "WHERE r.method = 'Stage-routed v2 policy' AND r.scope = 'ALL'", _SCORED))
def q_headline(t: Journeys) -> DataFrame:
    rows = _scored_rows(t)
    h = EV.headline(EV.regression_metrics(rows, _ALL_METHODS), EV.risk_metrics(rows))
    return h.select(*[r6(c).alias(c) for c in h.columns])


@register("risk_report", O.sql(
    f"SELECT '{EV.RISK_METHOD}' AS method, scope, round(ap.pr_auc, 3) AS pr_auc, round(prf.brier_score, 3) AS brier_score, "
    "round(prf.f1, 3) AS f1 FROM prf JOIN ap USING (scope)", _SCORED))
def q_risk_report(t: Journeys) -> DataFrame:
    return RP.risk_report(EV.risk_metrics(_scored_rows(t)))


@register("calibrated_probability", O.sql(
    "SELECT snapshot_id, round(1.0 / (1.0 + exp(-(3.0 * p - 1.5))), 9) AS risk_probability FROM te", _SCORED))
def q_calibrated(t: Journeys) -> DataFrame:
    """I6 with given coefficients."""
    return _scored_rows(t).select("snapshot_id", F.round(
        RK.sigmoid_of_line("risk_probability", 3.0, -1.5), 9).alias("risk_probability"))


@register("oof_contract", O.sql(
    "SELECT (SELECT CAST(count(*) AS BIGINT) FROM snaps_s s ANTI JOIN oof USING (snapshot_id) WHERE s.split = 'train') AS missing, "
    "CAST(count(*) FILTER (WHERE route_material_delay_rate IS NULL) AS BIGINT) AS nulls, "
    "CAST(count(*) FILTER (WHERE route_material_delay_rate < 0 OR route_material_delay_rate > 1) AS BIGINT) AS out_of_range "
    "FROM oof", _oof_ctes()))
def q_oof_contract(t: Journeys) -> DataFrame:
    """I9 on the out-of-fold route rate."""
    tr = t.snapshots_of("train")
    raw = EN.oof_route_rate(tr, t.shipments_of("train"), t.cfg.folds, t.cfg.fold_salt(0), out="raw_oof_probability")
    return RK.oof_contract(raw, tr)


@register("stored_snapshots", O.sql("SELECT * FROM snaps"))
def q_stored_snapshots(t: Journeys) -> DataFrame:
    """A2, A1: the base tables written and read again with their fixed schemas."""
    import uuid
    from milepost.plans.layout import Layout
    from milepost.session import ensure_checkpoint_dir
    from milepost.sources import readers, sinks
    spark = t.snapshots.sparkSession
    lay = Layout(f"{ensure_checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}")
    t = t.materialize()  # four tables are written from it
    paths = sinks.write_base_tables(lay, t.shipments, t.events, t.snapshots, t.manifest)
    back = readers.read_table(spark, paths["snapshots"], "snapshots")
    return back.select([F.col(c).cast(kind) for c, kind in t.snapshots.dtypes])


def _published(t: Journeys, table: tuple[str, str]) -> DataFrame:
    """The scored rows' tables written by the job's own function over those of an
    earlier run (stood in for by empty ones), published, and one of them read again."""
    import uuid
    from milepost.plans.layout import Layout
    from milepost.plans.pipeline import write_scored
    from milepost.session import cut_lineage, ensure_checkpoint_dir, remove_folder
    from milepost.sources import publish
    spark = t.snapshots.sparkSession
    root = f"{ensure_checkpoint_dir(spark)}/published-{uuid.uuid4().hex}"
    rows = cut_lineage(_scored_rows(t).withColumns({
        "risk_raw_probability": F.col("weather_severity"), "risk_level": RK.risk_level(),
        "predicted_material_delay": RK.risk_alert()}))
    comparison = EV.regression_metrics(rows, _ALL_METHODS)
    for last in (False, True):
        staged = publish.stage(root)
        write_scored(staged, rows.where(F.lit(last)), comparison.where(F.lit(last)), EV.risk_metrics(rows).where(F.lit(last)),
                     EV.calibration_table(rows).where(F.lit(last)))
        publish.publish(spark, staged)
    back = cut_lineage(spark.read.parquet(Layout(root).path(*table)))
    remove_folder(spark, root)
    return back


@register("published_comparison", O.sql(
    "SELECT method, scope, n_snapshots, round(mae_hours, 6) AS mae_hours, round(rmse_hours, 6) AS rmse_hours FROM reg6",
    _SCORED))
def q_published_comparison(t: Journeys) -> DataFrame:
    m = _published(t, ("final_metrics", "final_test_model_comparison"))
    return m.withColumns({"mae_hours": r6("mae_hours"), "rmse_hours": r6("rmse_hours")})


@register("published_risk_predictions", O.sql(
    "SELECT shipment_id, snapshot_id, snapshot_stage, round(weather_severity, 6) AS risk_raw_probability, "
    "round(p, 6) AS risk_probability, CASE WHEN p <= 0.35 THEN 'LOW' WHEN p <= 0.65 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level, "
    "p >= 0.29 AS predicted_material_delay, target_is_materially_delayed FROM te6", _SCORED))
def q_published_risk(t: Journeys) -> DataFrame:
    p = _published(t, ("final_predictions", "final_test_risk_predictions"))
    return p.withColumns({"risk_raw_probability": r6("risk_raw_probability"), "risk_probability": r6("risk_probability")})


_WATERFALL_SQL = (
    "CASE snapshot_stage WHEN 'PORT_ARRIVED' THEN printf('planned customs %.2fh + customs deviation %.2fh + planned post-customs "
    f"%.2fh + post-customs deviation %.2fh', {O.EXACT_HOURS('snapshot_at', 'scheduled_customs_clearance_at')}, direct, "
    f"{O.EXACT_HOURS('scheduled_customs_clearance_at', 'scheduled_final_eta')}, structured) "
    "WHEN 'CUSTOMS_CLEARED' THEN printf('planned inland %.2fh + inland deviation %.2fh', "
    f"{O.EXACT_HOURS('snapshot_at', 'scheduled_final_eta')}, structured) ELSE '{RP.NOT_APPLICABLE}' END")
_CASE_COLUMNS = ("\"case\", shipment_id, snapshot_id, route, snapshot_stage, actions, "
                 f"{O.ISO(O.ADD_HOURS('scheduled_final_eta', 'b2'))} AS predicted_final_eta, {_WATERFALL_SQL} AS waterfall, "
                 "round(p, 3) AS risk_probability, p >= 0.29 AS alert, round(b2, 2) AS predicted_delay_hours, "
                 "round(target_final_delay_hours, 2) AS actual_final_delay_hours")


@register("case_rows", O.sql(
    f"SELECT {_CASE_COLUMNS} FROM ("
    f"(SELECT 'S1 highest risk' AS \"case\", *, {_REC_SQL} AS actions FROM te6 WHERE snapshot_stage = 'ORIGIN_DEPARTED' ORDER BY p DESC NULLS LAST, snapshot_id LIMIT 1) UNION ALL "
    f"(SELECT 'S2 highest structured deviation', *, {_REC_SQL} FROM te6 WHERE snapshot_stage = 'PORT_ARRIVED' ORDER BY direct + structured DESC NULLS LAST, snapshot_id LIMIT 1) UNION ALL "
    f"(SELECT 'S3 lowest risk', *, {_REC_SQL} FROM te6 WHERE snapshot_stage = 'CUSTOMS_CLEARED' ORDER BY p NULLS LAST, snapshot_id LIMIT 1))", _SCORED))
def q_case_rows(t: Journeys) -> DataFrame:
    """L4, all columns, on the deterministic predictions (delay: carry-forward;
    deviations: direct, structured; planned hours of the snapshots)."""
    rows = ET.s3_targets(ET.s2_targets(_scored_rows(t))).withColumns({
        "predicted_customs_deviation_hours": F.col("direct"), "predicted_post_customs_deviation_hours": F.col("structured"),
        "predicted_inland_deviation_hours": F.col("structured"),
        "predicted_final_delay_hours": F.col("b2_predicted_delay_hours"),
        "predicted_final_eta": ET.predicted_eta("b2_predicted_delay_hours"),
        "predicted_material_delay": RK.risk_alert()})
    return RP.case_rows(rows).withColumn("actions", F.array_join("actions", " | "))


@register("validation_report", O.sql(
    "SELECT method, scope, n_snapshots, round(mae_hours, 3) AS mae_hours, round(rmse_hours, 3) AS rmse_hours FROM reg6 "
    "WHERE method NOT LIKE 'B%'", _SCORED))
def q_validation_report(t: Journeys) -> DataFrame:
    """The table of the three ETA methods."""
    return RP.report_metrics(EV.regression_metrics(_scored_rows(t), _ALL_METHODS), RP.ETA_REPORT_METHODS)


_SUMMARY_METRICS = ("eta_mae_hours", "eta_rmse_hours", "risk_pr_auc", "risk_brier_score", "risk_f1")


@register("run_summary", O.sql(
    "SELECT 'Stage-routed v2 ETA plus Risk HGB v2 Stack' AS policy, CAST("
    f"{Config().seed} AS BIGINT) AS seed, " + ", ".join(
        f"(SELECT CAST(count(*) FILTER (WHERE split = '{x}') AS BIGINT) FROM manifest) AS {x}" for x in ("train", "validation", "test"))
    + ", (SELECT CAST(count(*) AS BIGINT) FROM te) AS test_snapshots, " + ", ".join(
        f"(SELECT CAST(count(*) FILTER (WHERE snapshot_stage = '{x}') AS BIGINT) FROM te) AS {x.lower()}" for x in Config().stages)
    + ", CAST(0.29 AS DOUBLE) AS risk_threshold, true AS no_post_test_tuning, "
    "round(r.mae_hours, 6) AS eta_mae_hours, round(r.rmse_hours, 6) AS eta_rmse_hours, round(ap.pr_auc, 6) AS risk_pr_auc, "
    "round(prf.brier_score, 6) AS risk_brier_score, round(prf.f1, 6) AS risk_f1, 'a,b' AS report_paths "
    "FROM reg6 r JOIN prf USING (scope) JOIN ap USING (scope) "
    "WHERE r.method = 'Stage-routed v2 policy' AND r.scope = 'ALL'", _SCORED))
def q_run_summary(t: Journeys) -> DataFrame:
    """A4: the job's own record (pipeline.summary_record), all fields, written as JSON and
    read again; the paths are two stand-ins."""
    import uuid
    from milepost.plans.pipeline import summary_record
    from milepost.session import ensure_checkpoint_dir
    from milepost.sources import sinks
    spark = t.snapshots.sparkSession
    t = t.materialize()
    rows = _scored_rows(t)
    record = summary_record(t.cfg, t.manifest, rows, EV.regression_metrics(rows, _ALL_METHODS), EV.risk_metrics(rows),
                            {"cases": "b", "quality": "a"})
    path = f"{ensure_checkpoint_dir(spark)}/summary-{uuid.uuid4().hex}"
    sinks.write_summary(spark, record, path)
    counts = "map<string, bigint>"
    out = spark.read.schema(f"policy string, seed bigint, split_shipments {counts}, test_snapshots bigint, test_snapshots_by_stage {counts}, "
                            "risk_threshold double, no_post_test_tuning boolean, report_paths map<string, string>, "
                            + ", ".join(f"{c} double" for c in _SUMMARY_METRICS)).json(path)
    return out.select(
        "policy", "seed", *[F.col("split_shipments")[x].alias(x) for x in ("train", "validation", "test")], "test_snapshots",
        *[F.col("test_snapshots_by_stage")[x].alias(x.lower()) for x in t.cfg.stages], "risk_threshold", "no_post_test_tuning",
        *[r6(c).alias(c) for c in _SUMMARY_METRICS],
        F.array_join(F.array_sort(F.map_values("report_paths")), ",").alias("report_paths"))


# ---------------------------------------------------------------- I4, H1/H5/I5 and A5 on fixed ensembles
_NEWTON = """
c AS MATERIALIZED (SELECT p AS s, CAST(target_is_materially_delayed AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS n
                   FROM te WHERE p IS NOT NULL GROUP BY ALL),
newton(k, w, b) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
  UNION ALL
  SELECT k + 1, w - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01), b - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01)
  FROM (SELECT k, w, b, sum(n * (p - y)) AS g0, sum(n * (p - y) * s) + w AS g1, sum(n * p * (1 - p)) AS h00,
               sum(n * p * (1 - p) * s) AS h01, sum(n * p * (1 - p) * s * s) + 1 AS h11
        FROM (SELECT k, w, b, s, y, n, 1 / (1 + exp(-(w * s + b))) AS p FROM newton, c WHERE k < 20)
        GROUP BY k, w, b))"""


@register("platt_fit", O.sql("SELECT round(w, 6) AS slope, round(b, 6) AS intercept FROM newton WHERE k = 20",
                             _SCORED + "," + _NEWTON).replace("WITH ", "WITH RECURSIVE ", 1))
def q_platt(t: Journeys) -> DataFrame:
    """I4 on the continuous score."""
    line = RK.fit_platt(_scored_rows(t), "risk_probability", "target_is_materially_delayed")
    return t.journeys.sparkSession.createDataFrame(
        [(round(line.coefficients[0], 6) + 0.0, round(line.intercept, 6) + 0.0)], "slope double, intercept double")


# A small ensemble, given: (tree, node, feature, cut, left, right, value).
_NODES = [(0, 0, 0, 0.5, 1, 2, None), (0, 1, 2, 3.0, 3, 4, None), (0, 2, None, None, None, None, 0.9),
          (0, 3, None, None, None, None, -0.8), (0, 4, None, None, None, None, 0.15),
          (1, 0, 1, 0.35, 1, 2, None), (1, 1, None, None, None, None, 0.4), (1, 2, 0, 0.8, 3, 4, None),
          (1, 3, None, None, None, None, -0.5), (1, 4, None, None, None, None, 0.25),
          (2, 0, 2, 10.0, 1, 2, None), (2, 1, 2, 1.5, 3, 4, None), (2, 2, None, None, None, None, 1.1),
          (2, 3, None, None, None, None, -0.3), (2, 4, None, None, None, None, 0.05)]
_TREE_FEATURES = ["congestion_score", "document_readiness_score", "observed_port_arrival_delay_hours"]
_SLOPE, _OFFSET = 3.25, -1.5
_TREES = f"""
nodes(tree, node, feature, cut, lft, rgt, value) AS (VALUES {", ".join(
    "(" + ", ".join("NULL" if x is None else str(x) for x in n) + ")" for n in _NODES)}),
med AS (SELECT {", ".join(f"median({c}) AS m{i}" for i, c in enumerate(_TREE_FEATURES))} FROM snaps_s WHERE split = 'train'),
x AS (SELECT snapshot_id, [{", ".join(f"CAST(coalesce({c}, m{i}) AS DOUBLE)" for i, c in enumerate(_TREE_FEATURES))}] AS f
      FROM snaps_s, med WHERE split = 'validation'),
d1 AS (SELECT snapshot_id, f, tree, CASE WHEN f[feature + 1] <= cut THEN lft ELSE rgt END AS node FROM x, nodes WHERE node = 0),
d2 AS (SELECT snapshot_id, f, tree, CASE WHEN value IS NOT NULL THEN node WHEN f[feature + 1] <= cut THEN lft ELSE rgt END AS node
       FROM d1 JOIN nodes USING (tree, node)),
total AS (SELECT snapshot_id, sum(CAST(value AS DOUBLE)) AS score FROM d2 JOIN nodes USING (tree, node) GROUP BY snapshot_id),
decided AS (SELECT snapshot_id, raw, 1 / (1 + exp(-({_SLOPE} * raw + {_OFFSET}))) AS p
            FROM (SELECT snapshot_id, 1 / (1 + exp(-2 * score)) AS raw FROM total))"""


def _ensemble(t: Journeys):
    """Encoder fitted on train and the given ensemble, over the same features."""
    import json

    from milepost.operators import saved
    encoder = saved.FeatureEncoder(numericCols=_TREE_FEATURES, outputCol="features").fit(t.snapshots_of("train"))
    places = [encoder.feature_names().index(c) for c in _TREE_FEATURES]
    nodes = json.dumps([(a, b, None if i is None else places[i], *rest) for a, b, i, *rest in _NODES])
    return encoder, nodes, saved


@register("tree_scores", O.sql("SELECT snapshot_id, round(score, 9) AS score FROM total", _TREES))
def q_tree_scores(t: Journeys) -> DataFrame:
    """H1, H5: a boosted ensemble scored from its node table."""
    encoder, nodes, saved = _ensemble(t)
    scored = saved.TreeTable(nodes=nodes, vectorCol="features", outputCol="score").transform(
        encoder.transform(t.snapshots_of("validation")))
    return scored.select("snapshot_id", F.round("score", 9).alias("score"))


@register("saved_pipeline", O.sql(
    "SELECT snapshot_id, round(raw, 9) AS risk_raw_probability, round(p, 9) AS risk_probability, "
    "CASE WHEN p <= 0.35 THEN 'LOW' WHEN p <= 0.65 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level, "
    "p >= 0.29 AS predicted_material_delay FROM decided", _TREES))
def q_saved_pipeline(t: Journeys) -> DataFrame:
    """Imputer, ensemble, calibration and decision as one saved pipeline,
    read as a new object before it scores."""
    from pyspark.ml import PipelineModel
    encoder, nodes, saved = _ensemble(t)
    raw = saved.TreeTable(nodes=nodes, vectorCol="features", probability=True, outputCol="risk_raw_probability")
    model = saved.saved_and_loaded(PipelineModel([encoder, raw, saved.RiskDecision(slope=_SLOPE, intercept=_OFFSET)]),
                                   t.journeys.sparkSession)
    out = model.transform(t.snapshots_of("validation"))
    return out.select("snapshot_id", F.round("risk_raw_probability", 9).alias("risk_raw_probability"),
                      F.round("risk_probability", 9).alias("risk_probability"), "risk_level", "predicted_material_delay")
