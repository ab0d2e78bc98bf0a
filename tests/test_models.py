from dataclasses import replace

"""H1-H11, I1-I9: routing, ETA arithmetic, cross-fit isolation, OOF contract."""
from pyspark.sql import functions as F

from milepost.operators import eta as ET
from milepost.operators import risk as RK


def test_stage_routing_and_eta_arithmetic(small, tiny_cfg):
    tr, ts, va = small.snapshots_of("train"), small.shipments_of("train"), small.snapshots_of("validation")
    _, pred = ET.fit_eta(tr, ts, va, tiny_cfg)
    pred = pred.cache()
    assert pred.count() == va.count()
    labels = {(r.snapshot_stage, r.selected_eta_model) for r in
              pred.select("snapshot_stage", "selected_eta_model").distinct().collect()}
    assert labels == {("ORIGIN_DEPARTED", "Direct HGB v2"), ("PORT_ARRIVED", "Structured HGB v2"),
                      ("CUSTOMS_CLEARED", "Structured HGB v2")}
    # predicted ETA - scheduled final = predicted delay (within one second)
    diff = pred.select(
        (F.abs(F.timestamp_diff("SECOND", F.col("scheduled_final_eta"),
                                F.to_timestamp("predicted_final_eta", "yyyy-MM-dd'T'HH:mm:ss'Z'")) / 3600.0
               - F.col("predicted_final_delay_hours"))).alias("d"))
    assert diff.agg(F.max("d")).first()[0] <= 1 / 3600 + 1e-9
    # waterfall identities: S2 delay = customs + post deviations; S3 delay = inland deviation
    s2 = pred.where("snapshot_stage = 'PORT_ARRIVED'").select(F.max(F.abs(
        F.col("structured_v2_predicted_final_delay_hours") - F.col("predicted_customs_deviation_hours")
        - F.col("predicted_post_customs_deviation_hours")))).first()[0]
    s3 = pred.where("snapshot_stage = 'CUSTOMS_CLEARED'").select(F.max(F.abs(
        F.col("structured_v2_predicted_final_delay_hours") - F.col("predicted_inland_deviation_hours")))).first()[0]
    assert s2 < 1e-5 and s3 < 1e-5
    assert pred.where("snapshot_stage = 'ORIGIN_DEPARTED' AND structured_v2_predicted_final_delay_hours IS NOT NULL").count() == 0


def test_eta_oof_never_fits_a_holdout_shipment(small, tiny_cfg, monkeypatch):
    rows, ships = small.snapshots_of("validation"), small.shipments_of("validation")
    calls = []

    def ids(df):
        return {r[0] for r in df.select("shipment_id").collect()}

    def spy_fit(train, s2, s3, cfg, preps=None):
        calls.append([ids(train) | ids(s2) | ids(s3)])

    def spy_predict(models, held, keep, cfg):
        calls[-1].append(ids(held))
        return held.withColumn("predicted_final_delay_hours", F.lit(0.0))

    monkeypatch.setattr(ET, "fit_models", spy_fit)
    monkeypatch.setattr(ET, "predict_eta", spy_predict)
    out = ET.eta_oof(rows, ships, replace(tiny_cfg, parallel_fits=1))
    assert out.count() == rows.count() and out.where("predicted_final_delay_hours IS NULL").count() == 0
    assert len(calls) == 5
    assert all(not (fit & held) for fit, held in calls)
    assert set().union(*[h for _, h in calls]) == ids(rows)


def test_risk_stack_contract(small, tiny_cfg):
    tr, ts, va = small.snapshots_of("train"), small.shipments_of("train"), small.snapshots_of("validation")
    _, eta_pred = ET.fit_eta(tr, ts, va, tiny_cfg)
    models, pred = RK.fit_risk_stack(tr, ts, va, eta_pred, tiny_cfg)
    c = RK.oof_contract(models.raw_oof, tr).first()
    assert (c.missing, c.nulls, c.out_of_range) == (0, 0, 0)
    p = pred.cache()
    assert p.count() == va.count()
    assert p.where("risk_probability < 0 OR risk_probability > 1 OR risk_probability IS NULL").count() == 0
    assert p.where("predicted_material_delay <> (risk_probability >= 0.29)").count() == 0
    assert models.platt.coefficients[0] > 0  # calibrated probability increases with the raw one


def test_boosting_partitions_follow_rows_cores_and_fits_beside(spark):
    from milepost.config import Config
    from milepost.operators.eta import sharing, sized
    cores = spark.sparkContext.defaultParallelism
    data = spark.range(0, 100, 1, 64)
    parts = lambda n, beside=1: sized(data, n, beside).rdd.getNumPartitions()
    assert parts(0) == parts(50_000) == 1 and parts(100_000) == min(2, cores)
    assert parts(1_400_000) == max(4, min(28, cores)) and parts(1_400_000, 5 * cores) == 4
    assert parts(8_000_000) == max(20, cores)
    assert sharing(Config(), 5).direct.beside == 5 and sharing(Config(parallel_fits=1), 5).structured.beside == 1
