"""Journey derivation and as-of snapshots."""
import datetime as dt

from pyspark.sql import functions as F

from milepost.operators import derive as D


def test_counts_match_fixture_expectations(small):
    sh, ev, sn = small.shipments, small.events, small.snapshots
    assert sh.count() == 1473
    assert sh.where("final_delay_hours > 12").count() == 627
    assert sh.where("final_delay_hours = 12").count() == 3
    assert sh.where("is_materially_delayed = 1").count() == 627  # strict >
    assert ev.count() == 7365
    agg = ev.agg(F.sum(F.col("is_update_missing").cast("int")).alias("m"),
                 F.sum(F.col("is_late_update").cast("int")).alias("l")).first()
    assert (agg.m, agg.l) == (369, 1001)
    by_stage = {r[0]: r[1] for r in sn.groupBy("snapshot_stage").count().collect()}
    assert by_stage == {"ORIGIN_DEPARTED": 1399, "PORT_ARRIVED": 1400, "CUSTOMS_CLEARED": 1399}
    unseen = {r[0]: r[1] for r in sn.where("upstream_missing_update_count > 0")
              .groupBy("snapshot_stage").count().collect()}
    assert unseen == {"PORT_ARRIVED": 74, "CUSTOMS_CLEARED": 172}


def test_events_path_equals_wide_path(small):
    wide = small.snapshots
    via_events = D.snapshots_from_events(small.shipments, small.events)
    assert wide.exceptAll(via_events).count() == 0
    assert via_events.exceptAll(wide).count() == 0


def test_delay_identities(small):
    j = small.journeys
    bad = j.where(F.abs(F.col("final_delay_hours") - F.col("customs_delay_hours")
                        - F.col("inland_incremental_delay_hours")) > 0.0015).count()
    assert bad == 0


def _journey(spark, r0, r1, r2):
    t0 = dt.datetime(2024, 1, 1)
    row = dict(shipment_id="S1", route="R", origin="o", destination_port="p", final_destination="f",
               carrier="c", cargo_type="g", weather_severity=0.1, congestion_score=0.2,
               document_readiness_score=0.3, truck_availability_score=0.4,
               planned_ocean_hours=10.0, planned_customs_hours=5.0, planned_inland_hours=4.0,
               dispatch_buffer_hours=1.0, scheduled_departure_at=t0,
               departure_delay_s=0, ocean_increment_s=3600, customs_increment_s=0,
               dispatch_increment_s=0, final_increment_s=0, update_delay_s=[r0, r1, r2, 60, 60])
    legs = spark.createDataFrame([row], "shipment_id string, route string, origin string, destination_port string,"
                                 " final_destination string, carrier string, cargo_type string,"
                                 " weather_severity double, congestion_score double, document_readiness_score double,"
                                 " truck_availability_score double, planned_ocean_hours double,"
                                 " planned_customs_hours double, planned_inland_hours double,"
                                 " dispatch_buffer_hours double, scheduled_departure_at timestamp_ntz,"
                                 " departure_delay_s bigint, ocean_increment_s bigint, customs_increment_s bigint,"
                                 " dispatch_increment_s bigint, final_increment_s bigint, update_delay_s array<bigint>")
    _, sh, ev, sn = D.derive_all(legs)
    return sh, ev, sn


def test_asof_tie_counts_and_one_second_later_does_not(spark):
    # departure actual t0, port actual t0 + 11h; departure reported exactly at the
    # port report instant -> counts; then one second later -> does not count.
    port_report = 11 * 3600 + 60
    _, _, sn = _journey(spark, port_report, 60, 60)
    s2 = sn.where("snapshot_stage = 'PORT_ARRIVED'").first()
    assert s2.observed_departure_delay_hours == 0.0 and s2.upstream_missing_update_count == 0
    _, _, sn = _journey(spark, port_report + 1, 60, 60)
    s2 = sn.where("snapshot_stage = 'PORT_ARRIVED'").first()
    assert s2.observed_departure_delay_hours is None
    assert s2.upstream_missing_update_count == 1 and s2.event_completeness_score == 0.5


def test_missing_trigger_emits_no_snapshot(spark):
    _, ev, sn = _journey(spark, 60, None, 60)
    assert sn.where("snapshot_stage = 'PORT_ARRIVED'").count() == 0
    assert sn.count() == 2
    s3 = sn.where("snapshot_stage = 'CUSTOMS_CLEARED'").first()
    assert s3.observed_port_arrival_delay_hours is None and s3.upstream_missing_update_count == 1
    e = ev.where("milestone = 'PORT_ARRIVED'").first()
    assert e.is_update_missing and not e.is_late_update and e.update_delay_hours is None


def test_late_update_boundary_is_strict(spark):
    _, ev, _ = _journey(spark, 4 * 3600, 4 * 3600 + 1, 60)
    flags = {r.milestone: r.is_late_update for r in ev.collect()}
    assert flags["ORIGIN_DEPARTED"] is False and flags["PORT_ARRIVED"] is True


def test_material_label_boundary(spark):
    df = spark.createDataFrame([(12.0,), (12.001,)], "final_delay_hours double")
    assert [r[0] for r in df.select(D.material_label()).collect()] == [0, 1]


def test_iso_format_truncates(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 6, 7, 8, 9, 999000),)], "t timestamp_ntz")
    assert D.iso_format(df, ["t"]).first().t_iso == "2024-05-06T07:08:09Z"
