"""Explicit StructTypes of the journey tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, B, TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SHIPMENTS = _struct([
    ("route", S), ("origin", S), ("destination_port", S), ("final_destination", S),
    ("planned_ocean_hours", D), ("planned_customs_hours", D), ("planned_inland_hours", D),
    ("dispatch_buffer_hours", D), ("shipment_id", S), ("carrier", S), ("cargo_type", S),
    ("weather_severity", D), ("congestion_score", D), ("document_readiness_score", D),
    ("truck_availability_score", D),
    ("scheduled_departure_at", TS), ("scheduled_port_arrival_at", TS),
    ("scheduled_customs_clearance_at", TS), ("scheduled_inland_dispatch_at", TS), ("scheduled_final_eta", TS),
    ("actual_departure_at", TS), ("actual_port_arrival_at", TS), ("actual_customs_clearance_at", TS),
    ("actual_inland_dispatch_at", TS), ("actual_final_delivery_at", TS),
    ("departure_delay_hours", D), ("port_arrival_delay_hours", D), ("customs_incremental_delay_hours", D),
    ("inland_incremental_delay_hours", D), ("final_delay_hours", D), ("is_materially_delayed", I),
])

EVENTS = _struct([
    ("shipment_id", S), ("milestone", S), ("location", S), ("scheduled_at", TS), ("actual_at", TS),
    ("delay_vs_schedule_hours", D), ("reported_at", TS), ("is_update_missing", B),
    ("is_late_update", B), ("update_delay_hours", D),
])

SNAPSHOTS = _struct([
    ("snapshot_id", S), ("shipment_id", S), ("snapshot_stage", S), ("snapshot_at", TS),
    ("origin", S), ("destination_port", S), ("final_destination", S), ("route", S), ("carrier", S),
    ("cargo_type", S), ("planned_ocean_hours", D), ("planned_customs_hours", D), ("planned_inland_hours", D),
    ("scheduled_departure_at", TS), ("scheduled_port_arrival_at", TS), ("scheduled_customs_clearance_at", TS),
    ("scheduled_inland_dispatch_at", TS), ("scheduled_final_eta", TS),
    ("weather_severity", D), ("congestion_score", D), ("document_readiness_score", D),
    ("observed_departure_delay_hours", D), ("observed_port_arrival_delay_hours", D),
    ("observed_customs_delay_hours", D), ("truck_availability_score", D),
    ("upstream_missing_update_count", I), ("event_completeness_score", D),
    ("target_final_delay_hours", D), ("target_is_materially_delayed", I),
    ("target_actual_final_delivery_at", TS),
])

MANIFEST = _struct([("shipment_id", S), ("split", S), ("split_seed", I)])

SCHEMAS = {"shipments": SHIPMENTS, "events": EVENTS, "snapshots": SNAPSHOTS, "split_manifest": MANIFEST}
