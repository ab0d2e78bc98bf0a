"""F1-F5, F10-F15 and the preprocessor."""
from pyspark.sql import functions as F

from milepost.operators import features as FE


def test_feature_frame_has_no_ids_or_targets(small):
    cols = FE.base_features(small.snapshots, keep=()).columns
    assert cols == FE.CATEGORICAL + FE.NUMERIC
    assert FE.leakage_columns(cols) == []
    assert set(FE.leakage_columns(["snapshot_id", "target_x", "actual_y", "route_id"])) == {
        "snapshot_id", "target_x", "actual_y"}


def test_interaction_present_and_null_propagates(small):
    v = FE.interactions(small.snapshots)
    s1 = v.where("snapshot_stage = 'ORIGIN_DEPARTED'").select("port_delay_x_congestion").distinct().collect()
    assert s1 == [(None,)]


def test_calendar_weekday_monday_zero(spark):
    import datetime as dt
    df = spark.createDataFrame([("ORIGIN_DEPARTED", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)),
                                ("CUSTOMS_CLEARED", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)),
                                ("OTHER", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3))],
                               "snapshot_stage string, scheduled_departure_at timestamp_ntz, "
                               "scheduled_port_arrival_at timestamp_ntz")
    assert [r[0] for r in df.select(FE.calendar_dow()).collect()] == [0.0, 2.0, None]


def test_imputer_indicator_only_for_missing_columns_and_drops_all_missing(spark):
    df = spark.createDataFrame([(1.0, None, None), (3.0, 2.0, None), (5.0, 4.0, None)],
                               "a double, b double, c double")
    prep = FE.fit_preprocessor(df, ["a", "b", "c"])
    assert prep.numeric == ["a", "b"] and prep.indicators == ["b"] and prep.medians == {"a": 3.0, "b": 3.0}
    out = prep.imputed(spark.createDataFrame([(None, None, 1.0)], "a double, b double, c double")).first()
    assert (out.a, out.b, out.missingindicator_b) == (3.0, 3.0, 1.0)


def test_mode_tie_smallest_and_unseen_one_hot_zero(spark):
    df = spark.createDataFrame([("B",), ("A",), ("B",), ("A",), ("C",)], "carrier string")
    prep = FE.fit_preprocessor(df, ["carrier"])
    assert prep.modes == {"carrier": "A"} and prep.levels == {"carrier": ["A", "B", "C"]}
    new = spark.createDataFrame([("Z",), (None,)], "carrier string")
    rows = prep.one_hot(new).select("carrier_A", "carrier_B", "carrier_C").collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0)]  # unseen -> zeros; NULL -> mode


def test_risk_feature_frame_order(small):
    rows = (small.snapshots.withColumn("observed_delay_vs_route_typical", F.lit(0.0))
            .withColumn("route_material_delay_rate", F.lit(0.5))
            .withColumn("stage_routed_predicted_final_delay_hours", F.lit(13.0)))
    out = FE.risk_feature_frame(rows, keep=())
    assert out.columns == FE.RISK_COLUMNS
    assert out.first().delay_margin_to_material_threshold == 1.0
