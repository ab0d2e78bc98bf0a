"""Journey derivation and as-of snapshots.

Everything here is row-local except ``reported_by_stage`` (one shuffle on
shipment_id, a fixed-size conditional pivot that aggregates map-side, so a hot
shipment id cannot blow up a task).  The wide path ``snapshots_from_journeys``
needs no shuffle at all: the five milestone reports ride on the journey row and
the as-of comparison is a handful of column predicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.config import MATERIAL_DELAY_HOURS, LATE_UPDATE_HOURS, MILESTONES, STAGES
from milepost.functions.time import (
    add_seconds, hours_between, iso_instant, round_hours_from_micros, micros_between,
)

SCHEDULED = ("scheduled_departure_at", "scheduled_port_arrival_at",
             "scheduled_customs_clearance_at", "scheduled_inland_dispatch_at",
             "scheduled_final_eta")
ACTUAL = ("actual_departure_at", "actual_port_arrival_at",
          "actual_customs_clearance_at", "actual_inland_dispatch_at",
          "actual_final_delivery_at")
LOCATION = ("origin", "destination_port", "destination_port", "destination_port",
            "final_destination")

SHIPMENT_COLUMNS = (
    "route", "origin", "destination_port", "final_destination",
    "planned_ocean_hours", "planned_customs_hours", "planned_inland_hours",
    "dispatch_buffer_hours", "shipment_id", "carrier", "cargo_type",
    "weather_severity", "congestion_score", "document_readiness_score",
    "truck_availability_score", *SCHEDULED, *ACTUAL,
    "departure_delay_hours", "port_arrival_delay_hours",
    "customs_incremental_delay_hours", "inland_incremental_delay_hours",
    "final_delay_hours", "is_materially_delayed",
)
EVENT_COLUMNS = ("shipment_id", "milestone", "location", "scheduled_at", "actual_at",
                 "delay_vs_schedule_hours", "reported_at", "is_update_missing",
                 "is_late_update", "update_delay_hours")
SNAPSHOT_COLUMNS = (
    "snapshot_id", "shipment_id", "snapshot_stage", "snapshot_at", "origin",
    "destination_port", "final_destination", "route", "carrier", "cargo_type",
    "planned_ocean_hours", "planned_customs_hours", "planned_inland_hours",
    *SCHEDULED, "weather_severity", "congestion_score", "document_readiness_score",
    "observed_departure_delay_hours", "observed_port_arrival_delay_hours",
    "observed_customs_delay_hours", "truck_availability_score",
    "upstream_missing_update_count", "event_completeness_score",
    "target_final_delay_hours", "target_is_materially_delayed",
    "target_actual_final_delivery_at",
)


def hours(a, b) -> Column:
    """B2: round((b - a) / 3600 s, 3), signed."""
    return round_hours_from_micros(micros_between(a, b))


def planned_schedule(df: DataFrame) -> DataFrame:
    """B1: port = dep + ocean; customs = port + customs; dispatch = customs +
    buffer; final = port + customs + inland (the buffer sits inside inland)."""
    def plus(ts, h):
        return F.timestamp_add("SECOND", (h * 3600).cast("bigint"), ts)
    dep = F.col("scheduled_departure_at")
    ocean, customs = F.col("planned_ocean_hours"), F.col("planned_customs_hours")
    return df.withColumns({
        "scheduled_port_arrival_at": plus(dep, ocean),
        "scheduled_customs_clearance_at": plus(dep, ocean + customs),
        "scheduled_inland_dispatch_at": plus(dep, ocean + customs + F.col("dispatch_buffer_hours")),
        "scheduled_final_eta": plus(dep, ocean + customs + F.col("planned_inland_hours")),
    })


def actuals_from_legs(df: DataFrame) -> DataFrame:
    """Actual instants = scheduled + cumulative leg delay (seconds inputs)."""
    dep = F.col("departure_delay_s")
    port = dep + F.col("ocean_increment_s")
    customs = port + F.col("customs_increment_s")
    dispatch = customs + F.col("dispatch_increment_s")
    final = dispatch + F.col("final_increment_s")
    return df.withColumns({
        a: add_seconds(s, c) for a, s, c in zip(ACTUAL, SCHEDULED, (dep, port, customs, dispatch, final))
    })


def delay_hours(df: DataFrame) -> DataFrame:
    """B2: signed milestone delays in hours."""
    return df.withColumns({
        "departure_delay_hours": hours("scheduled_departure_at", "actual_departure_at"),
        "port_arrival_delay_hours": hours("scheduled_port_arrival_at", "actual_port_arrival_at"),
        "customs_delay_hours": hours("scheduled_customs_clearance_at", "actual_customs_clearance_at"),
        "final_delay_hours": hours("scheduled_final_eta", "actual_final_delivery_at"),
    })


def incremental_delays(df: DataFrame) -> DataFrame:
    """Customs increment = customs leg over plan; inland = final - customs."""
    port_s = micros_between("scheduled_port_arrival_at", "actual_port_arrival_at")
    customs_s = micros_between("scheduled_customs_clearance_at", "actual_customs_clearance_at")
    final_s = micros_between("scheduled_final_eta", "actual_final_delivery_at")
    return df.withColumns({
        "customs_incremental_delay_hours": round_hours_from_micros(customs_s - port_s),
        "inland_incremental_delay_hours": round_hours_from_micros(final_s - customs_s),
    })


def material_label(col: str = "final_delay_hours",
                   threshold: float = MATERIAL_DELAY_HOURS) -> Column:
    """Strictly greater than the threshold."""
    return F.coalesce(F.col(col) > F.lit(threshold), F.lit(False)).cast("int")


def shipments_from_legs(legs: DataFrame, threshold: float = MATERIAL_DELAY_HOURS) -> DataFrame:
    """B1-B4 over journey legs; keeps ``update_delay_s`` for the event unpivot."""
    df = incremental_delays(delay_hours(actuals_from_legs(planned_schedule(legs))))
    return df.withColumn("is_materially_delayed", material_label(threshold=threshold))


def shipments_table(journeys: DataFrame) -> DataFrame:
    return journeys.select(*SHIPMENT_COLUMNS)


def with_reports(journeys: DataFrame) -> DataFrame:
    """reported_at per milestone = actual + update delay (NULL when missing)."""
    return journeys.withColumn("reported", F.array(*[
        add_seconds(ACTUAL[i], F.col("update_delay_s")[i]) for i in range(len(MILESTONES))
    ]))


def milestone_events(journeys: DataFrame, late_hours: float = LATE_UPDATE_HOURS) -> DataFrame:
    """B5 + B6: unpivot each journey into its five milestone events, no shuffle.

    Update status: missing iff reported_at is NULL; update delay = reported -
    actual; late iff delay > ``late_hours`` (strict); missing => not late."""
    journeys = journeys if "reported" in journeys.columns else with_reports(journeys)
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("milestone_idx"),
            F.lit(m).alias("milestone"),
            F.col(LOCATION[i]).alias("location"),
            F.col(SCHEDULED[i]).alias("scheduled_at"),
            F.col(ACTUAL[i]).alias("actual_at"),
            F.col("reported")[i].alias("reported_at"),
        )
        for i, m in enumerate(MILESTONES)
    ])
    ev = journeys.select("shipment_id", F.inline(rows))
    return update_status(ev, late_hours).withColumn(
        "delay_vs_schedule_hours", hours("scheduled_at", "actual_at"))


def update_status(events: DataFrame, late_hours: float = LATE_UPDATE_HOURS) -> DataFrame:
    """B6 on any events frame carrying ``actual_at`` and ``reported_at``."""
    delay = hours("actual_at", "reported_at")
    return events.withColumns({
        "is_update_missing": F.col("reported_at").isNull(),
        "update_delay_hours": delay,
        "is_late_update": F.coalesce(
            micros_between("actual_at", "reported_at") > F.lit(int(late_hours * 3_600_000_000)),
            F.lit(False)),
    })


def reported_by_stage(events: DataFrame, n_stages: int = len(STAGES)) -> DataFrame:
    """Events path of B8: one row per shipment with the reported instants of the
    snapshot-stage milestones (r0..r{n-1}); a fixed-size pivot, partial-aggregated."""
    return events.groupBy("shipment_id").agg(*[
        F.max(F.when((F.col("milestone") == MILESTONES[i]) & ~F.col("is_update_missing"),
                     F.col("reported_at"))).alias(f"r{i}")
        for i in range(n_stages)
    ])


def _stage_structs(stages=STAGES) -> Column:
    """B7 + B8 + B10 as per-row predicates over r0..r{n-1}.

    Milestone j <= i counts for stage i iff it was reported and
    reported_at_j <= reported_at_i (a tie counts, the trigger counts itself)."""
    items = []
    for i, stage in enumerate(stages):
        trig = F.col(f"r{i}")
        avail = [(F.col(f"r{j}").isNotNull() & (F.col(f"r{j}") <= trig)) for j in range(i + 1)]
        avail += [F.lit(False)] * (len(stages) - 1 - i)
        n_avail = sum((a.cast("int") for a in avail), F.lit(0))
        items.append(F.struct(
            F.lit(i + 1).alias("stage_no"),
            F.lit(stage).alias("snapshot_stage"),
            trig.alias("snapshot_at"),
            *[a.alias(f"avail_{j}") for j, a in enumerate(avail)],
            (F.lit(i + 1) - n_avail).alias("upstream_missing_update_count"),
            F.round(n_avail / F.lit(float(i + 1)), 3).alias("event_completeness_score"),
        ))
    return F.filter(F.array(*items), lambda s: s["snapshot_at"].isNotNull())


def expand_snapshots(journeys: DataFrame, threshold: float = MATERIAL_DELAY_HOURS,
                     stages=STAGES) -> DataFrame:
    """B7-B12 on journey rows that carry r0..r{n-1}: one snapshot per reported
    trigger, evidence gated by as-of availability, targets attached."""
    j = journeys.withColumn("customs_delay_hours", hours(
        "scheduled_customs_clearance_at", "actual_customs_clearance_at"))
    s = j.select("*", F.inline(_stage_structs(stages)))

    def gate(avail: str, value: str) -> Column:
        return F.when(F.col(avail), F.col(value).cast("double"))

    return s.select(
        F.concat_ws("-", "shipment_id", F.col("stage_no").cast("string")).alias("snapshot_id"),
        "shipment_id", "snapshot_stage", "snapshot_at", "origin", "destination_port",
        "final_destination", "route", "carrier", "cargo_type", "planned_ocean_hours",
        "planned_customs_hours", "planned_inland_hours", *SCHEDULED,
        "weather_severity", "congestion_score", "document_readiness_score",
        gate("avail_0", "departure_delay_hours").alias("observed_departure_delay_hours"),
        gate("avail_1", "port_arrival_delay_hours").alias("observed_port_arrival_delay_hours"),
        gate("avail_2", "customs_delay_hours").alias("observed_customs_delay_hours"),
        gate("avail_2", "truck_availability_score").alias("truck_availability_score"),
        "upstream_missing_update_count", "event_completeness_score",
        F.col("final_delay_hours").alias("target_final_delay_hours"),
        material_label(threshold=threshold).alias("target_is_materially_delayed"),
        F.col("actual_final_delivery_at").alias("target_actual_final_delivery_at"),
    )


def snapshots_from_journeys(journeys: DataFrame, threshold: float = MATERIAL_DELAY_HOURS,
                            stages=STAGES) -> DataFrame:
    """Wide path: reports ride on the journey row, zero shuffles."""
    journeys = journeys if "reported" in journeys.columns else with_reports(journeys)
    r = journeys.withColumns({f"r{i}": F.col("reported")[i] for i in range(len(stages))})
    return expand_snapshots(r, threshold, stages)


def snapshots_from_events(shipments: DataFrame, events: DataFrame,
                          threshold: float = MATERIAL_DELAY_HOURS, stages=STAGES) -> DataFrame:
    """Events path: pivot reports per shipment (1 shuffle) and join the
    shipments on the same key (the aggregate is already partitioned on it)."""
    reports = reported_by_stage(events, len(stages))
    j = shipments.join(reports, "shipment_id", "inner")
    return expand_snapshots(j, threshold, stages)


def iso_format(df: DataFrame, columns) -> DataFrame:
    """ISO-8601 'Z' strings, sub-seconds truncated."""
    return df.withColumns({f"{c}_iso": iso_instant(c) for c in columns})


def derive_all(legs: DataFrame, threshold: float = MATERIAL_DELAY_HOURS):
    """(journeys, shipments, events, snapshots) from journey legs."""
    return derive_from_journeys(with_reports(shipments_from_legs(legs, threshold)), threshold)


def derive_from_journeys(journeys: DataFrame, threshold: float = MATERIAL_DELAY_HOURS):
    """(journeys, shipments, events, snapshots) from journey rows with reports."""
    return (journeys, shipments_table(journeys), milestone_events(journeys)
            .select(*EVENT_COLUMNS), snapshots_from_journeys(journeys, threshold))


__all__ = [
    "ACTUAL", "SCHEDULED", "EVENT_COLUMNS", "SHIPMENT_COLUMNS", "SNAPSHOT_COLUMNS",
    "hours", "planned_schedule", "actuals_from_legs", "delay_hours", "incremental_delays",
    "material_label", "shipments_from_legs", "shipments_table", "with_reports",
    "milestone_events", "update_status", "reported_by_stage", "expand_snapshots",
    "snapshots_from_journeys", "snapshots_from_events", "iso_format", "derive_all",
    "hours_between",
]


def available_milestones(journeys: DataFrame, stages=STAGES) -> DataFrame:
    """B8 listed: (snapshot_id, milestone) for every milestone visible as of
    the snapshot (reported no later than the trigger)."""
    journeys = journeys if "reported" in journeys.columns else with_reports(journeys)
    r = journeys.withColumns({f"r{i}": F.col("reported")[i] for i in range(len(stages))})
    s = r.select("shipment_id", F.inline(_stage_structs(stages)))
    pairs = F.array(*[F.struct(F.col(f"avail_{j}").alias("ok"), F.lit(MILESTONES[j]).alias("milestone"))
                      for j in range(len(stages))])
    return (s.select(F.concat_ws("-", "shipment_id", F.col("stage_no").cast("string")).alias("snapshot_id"),
                     F.inline(pairs))
            .where(F.col("ok")).select("snapshot_id", "milestone"))
