"""DuckDB oracle SQL for the registered queries.

The prelude re-derives journeys, shipments, milestone events, snapshots and
the split manifest in plain SQL over the pre-registered test-data views.
Snapshots use the *range self-join* form of the as-of rule, independent of
the Spark pivot / wide implementation it checks.
"""

from __future__ import annotations

from milepost.config import SEED


def H(seconds: str) -> str:
    """round(seconds / 3600, 3), half away from zero, exact."""
    s = f"({seconds})"
    return f"(sign({s}) * floor((abs({s}) * 2000 + 3600) / 7200.0) / 1000.0)"


def HRS(a: str, b: str) -> str:
    return H(f"date_diff('second', {a}, {b})")


def EXACT_HOURS(a: str, b: str) -> str:
    return f"(CAST(date_diff('microsecond', {a}, {b}) AS DOUBLE) / 3600000000.0)"


def ADD_HOURS(ts: str, h: str) -> str:
    return f"({ts} + to_microseconds(CAST(round(({h}) * 3600000000.0) AS BIGINT)))"


def MD5INT(salt: str, key: str, digits: int = 8) -> str:
    return f"CAST(('0x' || substr(md5('{salt}:' || {key}), 1, {digits})) AS BIGINT)"


def FOLD(key: str, salt: str = str(SEED), k: int = 5) -> str:
    return f"CAST({MD5INT(salt, key)} % {k} AS INTEGER)"


def ISO(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


def LATEST(prefix: str = "") -> str:
    p = prefix
    return (f"(CASE WHEN {p}snapshot_stage = 'ORIGIN_DEPARTED' THEN {p}observed_departure_delay_hours "
            f"WHEN {p}snapshot_stage = 'PORT_ARRIVED' THEN {p}observed_port_arrival_delay_hours "
            f"ELSE {p}observed_customs_delay_hours END)")


def _upd(idx: int) -> str:
    base = f"(k * 101 + {idx * 7})"
    return (f"CASE WHEN (k * 31 + {idx * 17}) % 20 = 0 THEN NULL "
            f"WHEN (k * 11 + {idx * 13}) % 7 = 0 THEN 14460 + {base} % 200000 "
            f"ELSE 180 + {base} % 10000 END")


_MILESTONES = (
    (0, "ORIGIN_DEPARTED", "origin", "scheduled_departure_at", "actual_departure_at"),
    (1, "PORT_ARRIVED", "destination_port", "scheduled_port_arrival_at", "actual_port_arrival_at"),
    (2, "CUSTOMS_CLEARED", "destination_port", "scheduled_customs_clearance_at", "actual_customs_clearance_at"),
    (3, "INLAND_DISPATCHED", "destination_port", "scheduled_inland_dispatch_at", "actual_inland_dispatch_at"),
    (4, "FINAL_DELIVERED", "final_destination", "scheduled_final_eta", "actual_final_delivery_at"),
)

_EVENTS_UNION = "\n    UNION ALL\n".join(
    f"    SELECT shipment_id, {i} AS milestone_idx, '{m}' AS milestone, {loc} AS location, "
    f"{s} AS scheduled_at, {a} AS actual_at, {a} + to_seconds(CAST({_upd(i)} AS BIGINT)) AS reported_at FROM j"
    for i, m, loc, s, a in _MILESTONES)

MILESTONE_NAMES = [m for _, m, *_ in _MILESTONES]
# The first three reports side by side (NULL: missing).
REPORTS = "w AS MATERIALIZED (SELECT shipment_id, " + ", ".join(
    f"{a} + to_seconds(CAST({_upd(i)} AS BIGINT)) AS r{i}" for i, _, _, _, a in _MILESTONES[:3]) + " FROM act)"

SHIPMENT_COLS = """route, origin, destination_port, final_destination, planned_ocean_hours,
    planned_customs_hours, planned_inland_hours, dispatch_buffer_hours, shipment_id, carrier,
    cargo_type, weather_severity, congestion_score, document_readiness_score,
    truck_availability_score, scheduled_departure_at, scheduled_port_arrival_at,
    scheduled_customs_clearance_at, scheduled_inland_dispatch_at, scheduled_final_eta,
    actual_departure_at, actual_port_arrival_at, actual_customs_clearance_at,
    actual_inland_dispatch_at, actual_final_delivery_at, departure_delay_hours,
    port_arrival_delay_hours, customs_incremental_delay_hours, inland_incremental_delay_hours,
    final_delay_hours, is_materially_delayed"""

PRELUDE = f"""
li AS (
  SELECT l_orderkey, CAST(max(l_quantity) AS BIGINT) AS mq, CAST(min(l_quantity) AS BIGINT) AS nq,
         CAST(round(max(l_discount) * 100) AS BIGINT) AS md, CAST(round(max(l_tax) * 100) AS BIGINT) AS mt,
         CAST(count(*) AS BIGINT) AS nl
  FROM lineitem GROUP BY l_orderkey),
legs AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS shipment_id, CAST(o.o_orderkey AS BIGINT) AS k,
         CAST(r.r_regionkey AS BIGINT) AS rk, r.r_name AS route, n.n_name AS origin,
         r.r_name AS destination_port, c.c_name AS final_destination, o.o_orderpriority AS carrier,
         c.c_mktsegment AS cargo_type,
         CAST((CAST(o.o_orderkey AS BIGINT) * 37 + 11) % 100 AS DOUBLE) / 100.0 AS weather_severity,
         CAST((CAST(o.o_orderkey AS BIGINT) * 53 + 29) % 100 AS DOUBLE) / 100.0 AS congestion_score,
         CAST((CAST(o.o_orderkey AS BIGINT) * 71 + 5) % 100 AS DOUBLE) / 100.0 AS document_readiness_score,
         CAST((CAST(o.o_orderkey AS BIGINT) * 89 + 43) % 100 AS DOUBLE) / 100.0 AS truck_availability_score,
         o.o_orderdate AS scheduled_departure_at,
         CAST(240 + 24 * r.r_regionkey AS DOUBLE) AS planned_ocean_hours,
         CAST(32 + 2 * r.r_regionkey AS DOUBLE) AS planned_customs_hours,
         CAST(27 + r.r_regionkey AS DOUBLE) AS planned_inland_hours,
         CAST(3.0 AS DOUBLE) AS dispatch_buffer_hours,
         li.md * 3600 - 3 * 3600 AS dep_s,
         li.mq * 720 - 7 * 3600 + CAST(r.r_regionkey AS BIGINT) * 3600 AS ocean_s,
         li.mt * 2700 + li.nq * 600 - 4 * 3600 AS customs_s,
         li.nl * 900 - 3600 AS dispatch_s,
         li.nq * 900 - 2 * 3600 AS final_s
  FROM orders o JOIN li ON o.o_orderkey = li.l_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey),
sched AS (
  SELECT *,
    scheduled_departure_at + to_seconds(CAST(planned_ocean_hours * 3600 AS BIGINT)) AS scheduled_port_arrival_at,
    scheduled_departure_at + to_seconds(CAST((planned_ocean_hours + planned_customs_hours) * 3600 AS BIGINT)) AS scheduled_customs_clearance_at,
    scheduled_departure_at + to_seconds(CAST((planned_ocean_hours + planned_customs_hours + dispatch_buffer_hours) * 3600 AS BIGINT)) AS scheduled_inland_dispatch_at,
    scheduled_departure_at + to_seconds(CAST((planned_ocean_hours + planned_customs_hours + planned_inland_hours) * 3600 AS BIGINT)) AS scheduled_final_eta
  FROM legs),
act AS (
  SELECT *,
    scheduled_departure_at + to_seconds(dep_s) AS actual_departure_at,
    scheduled_port_arrival_at + to_seconds(dep_s + ocean_s) AS actual_port_arrival_at,
    scheduled_customs_clearance_at + to_seconds(dep_s + ocean_s + customs_s) AS actual_customs_clearance_at,
    scheduled_inland_dispatch_at + to_seconds(dep_s + ocean_s + customs_s + dispatch_s) AS actual_inland_dispatch_at,
    scheduled_final_eta + to_seconds(dep_s + ocean_s + customs_s + dispatch_s + final_s) AS actual_final_delivery_at
  FROM sched),
j AS (
  SELECT *,
    {HRS('scheduled_departure_at', 'actual_departure_at')} AS departure_delay_hours,
    {HRS('scheduled_port_arrival_at', 'actual_port_arrival_at')} AS port_arrival_delay_hours,
    {HRS('scheduled_customs_clearance_at', 'actual_customs_clearance_at')} AS customs_delay_hours,
    {HRS('scheduled_final_eta', 'actual_final_delivery_at')} AS final_delay_hours,
    {H("date_diff('second', scheduled_customs_clearance_at, actual_customs_clearance_at) - date_diff('second', scheduled_port_arrival_at, actual_port_arrival_at)")} AS customs_incremental_delay_hours,
    {H("date_diff('second', scheduled_final_eta, actual_final_delivery_at) - date_diff('second', scheduled_customs_clearance_at, actual_customs_clearance_at)")} AS inland_incremental_delay_hours,
    CAST({HRS('scheduled_final_eta', 'actual_final_delivery_at')} > 12.0 AS INTEGER) AS is_materially_delayed
  FROM act),
shipments_t AS (SELECT {SHIPMENT_COLS} FROM j),
ev0 AS (
{_EVENTS_UNION}),
mevents AS (
  SELECT shipment_id, milestone_idx, milestone, location, scheduled_at, actual_at,
         {HRS('scheduled_at', 'actual_at')} AS delay_vs_schedule_hours, reported_at,
         reported_at IS NULL AS is_update_missing,
         coalesce(date_diff('second', actual_at, reported_at) > 14400, false) AS is_late_update,
         {HRS('actual_at', 'reported_at')} AS update_delay_hours
  FROM ev0),
trig AS (
  SELECT shipment_id, milestone_idx AS i, reported_at AS snapshot_at FROM mevents
  WHERE milestone_idx < 3 AND reported_at IS NOT NULL),
avail AS (
  SELECT t.shipment_id, t.i, e.milestone_idx AS j, e.milestone
  FROM (SELECT shipment_id, i, snapshot_at, unnest(range(0, i + 1)) AS j FROM trig) t
  JOIN mevents e ON e.shipment_id = t.shipment_id AND e.milestone_idx = t.j
  WHERE e.reported_at IS NOT NULL AND e.reported_at <= t.snapshot_at),
av AS (
  SELECT t.shipment_id, t.i, t.snapshot_at, count(*) AS n_avail,
         bool_or(a.j = 0) AS a0, bool_or(a.j = 1) AS a1, bool_or(a.j = 2) AS a2
  FROM trig t JOIN avail a ON a.shipment_id = t.shipment_id AND a.i = t.i
  GROUP BY t.shipment_id, t.i, t.snapshot_at),
snaps AS (
  SELECT j.shipment_id || '-' || CAST(av.i + 1 AS VARCHAR) AS snapshot_id, j.shipment_id,
    CASE av.i WHEN 0 THEN 'ORIGIN_DEPARTED' WHEN 1 THEN 'PORT_ARRIVED' ELSE 'CUSTOMS_CLEARED' END AS snapshot_stage,
    av.snapshot_at, j.origin, j.destination_port, j.final_destination, j.route, j.carrier, j.cargo_type,
    j.planned_ocean_hours, j.planned_customs_hours, j.planned_inland_hours,
    j.scheduled_departure_at, j.scheduled_port_arrival_at, j.scheduled_customs_clearance_at,
    j.scheduled_inland_dispatch_at, j.scheduled_final_eta,
    j.weather_severity, j.congestion_score, j.document_readiness_score,
    CASE WHEN av.a0 THEN j.departure_delay_hours END AS observed_departure_delay_hours,
    CASE WHEN av.a1 THEN j.port_arrival_delay_hours END AS observed_port_arrival_delay_hours,
    CASE WHEN av.a2 THEN j.customs_delay_hours END AS observed_customs_delay_hours,
    CASE WHEN av.a2 THEN j.truck_availability_score END AS truck_availability_score,
    CAST(av.i + 1 - av.n_avail AS INTEGER) AS upstream_missing_update_count,
    round(CAST(av.n_avail AS DOUBLE) / CAST(av.i + 1 AS DOUBLE), 3) AS event_completeness_score,
    j.final_delay_hours AS target_final_delay_hours,
    CAST(j.final_delay_hours > 12.0 AS INTEGER) AS target_is_materially_delayed,
    j.actual_final_delivery_at AS target_actual_final_delivery_at
  FROM av JOIN j ON j.shipment_id = av.shipment_id),
ranked AS (
  SELECT shipment_id, row_number() OVER (ORDER BY h, shipment_id) - 1 AS pos, count(*) OVER () AS n
  FROM (SELECT DISTINCT shipment_id, {MD5INT(str(SEED), 'shipment_id', 15)} AS h FROM shipments_t)),
manifest AS (
  SELECT shipment_id,
    CASE WHEN pos < floor(CAST(n * 175 AS DOUBLE) / 250) THEN 'train'
         WHEN pos < floor(CAST(n * 175 AS DOUBLE) / 250) + floor(CAST(n * 37 AS DOUBLE) / 250) THEN 'validation'
         ELSE 'test' END AS split,
    CAST({SEED} AS INTEGER) AS split_seed
  FROM ranked),
snaps_s AS (SELECT s.*, m.split FROM snaps s JOIN manifest m USING (shipment_id)),
ship_s AS (SELECT s.*, m.split FROM shipments_t s JOIN manifest m USING (shipment_id))"""


def sql(body: str, extra: str = "") -> str:
    """Full oracle statement: prelude CTEs (+ extra CTEs) and the final SELECT."""
    ctes = PRELUDE + (",\n" + extra if extra else "")
    return f"WITH {ctes}\n{body}"
