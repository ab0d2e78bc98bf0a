"""Encoder, ensembles as tables, calibration: against other ways to the same numbers."""
import json
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from milepost.operators import eta as ET
from milepost.operators import features as FE
from milepost.operators import risk as RK
from milepost.operators import saved


@pytest.fixture(scope="module")
def frame(small):
    rows = small.snapshots_of("validation")
    gap = F.pmod(F.xxhash64("snapshot_id"), F.lit(9)) == 0
    return FE.with_base_features(rows).withColumn("carrier", F.when(~gap, F.col("carrier"))).cache()


def test_encoder_equals_the_column_form(frame):
    fit, other = frame.where("snapshot_stage <> 'CUSTOMS_CLEARED'"), frame
    encoder = saved.FeatureEncoder(numericCols=FE.NUMERIC, categoricalCols=FE.CATEGORICAL).fit(fit)
    prep = FE.fit_preprocessor(fit.select(*FE.CATEGORICAL, *FE.NUMERIC), FE.CATEGORICAL + FE.NUMERIC, "features")
    out = encoder.transform(other)
    assert out.columns == [*other.columns, "features"]

    def vectors(df):
        return {r.snapshot_id: r.v for r in df.select("snapshot_id", vector_to_array("features").alias("v")).collect()}

    assert vectors(out) == vectors(prep.transform(other))
    assert out.drop("features").exceptAll(other).isEmpty()  # the columns stay as they were


def test_a_hundred_thousand_levels(spark):
    n = 100_000
    rows = spark.range(n + n // 2).select(F.concat(F.lit("level-"), F.pmod("id", F.lit(n))).alias("route_id"),
                                          F.col("id").cast("double").alias("x"))
    model = saved.FeatureEncoder(numericCols=["x"], categoricalCols=["route_id"]).fit(rows)
    plan = model.transform(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "level-77777" not in plan and len(plan) < 40_000
    assert len(json.dumps(model.getOrDefault("fitted"))) < 500  # what the driver holds
    index = model.levels.agg(F.count("*"), F.countDistinct("index"), F.min("index"), F.max("index")).first()
    assert tuple(index) == (n, n, 0, n - 1)
    ordered = model.levels.orderBy("index").select("level").limit(2000).collect()
    assert [r.level for r in ordered] == sorted(f"level-{i}" for i in range(n))[:2000]
    some = spark.createDataFrame([("level-5", 1.0), ("new", 2.0), (None, None)], "route_id string, x double")
    got = [r.features for r in model.transform(some).orderBy(F.col("x").asc_nulls_last()).collect()]
    place = {r.level: r["index"] for r in model.levels.where("level IN ('level-5', 'level-0')").collect()}
    assert [v.size for v in got] == [n + 1] * 3
    assert got[0][1 + place["level-5"]] == 1 and got[0].numNonzeros() == 2  # x and the level
    assert got[1].numNonzeros() == 1  # an unknown level: zeros
    assert got[2][1 + place["level-0"]] == 1  # missing: the most frequent one, the smallest of equals


def test_encoder_refuses_leaking_columns(frame):
    with pytest.raises(ValueError, match="not allowed"):
        saved.FeatureEncoder(numericCols=["target_final_delay_hours"]).fit(frame)


@pytest.mark.parametrize("encoded", [False, True])
def test_node_table_scores_like_the_fitted_model(frame, tiny_cfg, encoded):
    if encoded:  # one-hot places split by value instead of a cut
        data = saved.FeatureEncoder(numericCols=FE.NUMERIC, categoricalCols=FE.CATEGORICAL, outputCol="v").fit(frame).transform(frame)
    else:
        ready = frame.na.fill(0.0, FE.NUMERIC)
        data = VectorAssembler(inputCols=FE.NUMERIC, outputCol="v").transform(ready)
    data = data.withColumn("y", F.col("target_final_delay_hours"))
    model = ET.gbt_regressor(tiny_cfg.direct, 7, "v", "y", "p").fit(data)
    nodes = saved.node_table(model)
    assert {len(n) for n in nodes} == {7} and len({n[0] for n in nodes}) == tiny_cfg.direct.max_iter
    table = saved.TreeTable(nodes=json.dumps(nodes), vectorCol="v", outputCol="score")
    worst = model.transform(table.transform(data)).agg(F.max(F.abs(F.col("p") - F.col("score")))).first()[0]
    assert worst < 1e-9


def test_saved_risk_model_scores_alike(frame, tiny_cfg, tmp_path):
    encoder = saved.FeatureEncoder(numericCols=FE.NUMERIC, categoricalCols=FE.CATEGORICAL).fit(frame)
    data = encoder.transform(frame).withColumn("y", F.col("target_is_materially_delayed").cast("double"))
    fitted = RK.gbt_classifier(tiny_cfg, "features", "y").fit(data)
    trees = saved.TreeTable(nodes=json.dumps(saved.node_table(fitted)), vectorCol="features", probability=True,
                            outputCol="risk_raw_probability")
    model = PipelineModel([encoder, trees, saved.RiskDecision(slope=2.0, intercept=-1.0)])
    again = saved.saved_and_loaded(model, frame.sparkSession, str(tmp_path / "m"))
    assert [type(s) for s in again.stages] == [type(s) for s in model.stages]
    columns = ["snapshot_id", "risk_raw_probability", "risk_probability", "risk_level", "predicted_material_delay"]
    want = {tuple(r) for r in model.transform(frame).select(*columns).collect()}
    assert {tuple(r) for r in again.transform(frame).select(*columns).collect()} == want
    own = fitted.transform(trees.transform(data)).select(
        F.max(F.abs(vector_to_array("probability")[1] - F.col("risk_raw_probability")))).first()[0]
    assert own < 1e-9


@pytest.mark.parametrize("case", ["mixed", "few scores", "steep", "missing"])
def test_platt_equals_logistic_regression(spark, case):
    from pyspark.ml.classification import LogisticRegression
    r = random.Random(len(case))
    score = {"few scores": lambda: r.choice([0.1, 0.4, 0.8]), "steep": lambda: r.choice([0.001, 0.999])}.get(case, r.random)
    rows = [(s := score(), int(r.random() < (s if case != "steep" else s > 0.5))) for _ in range(600)]
    more = [(None, 1), (0.3, None)] if case == "missing" else []
    line = RK.fit_platt(spark.createDataFrame(rows + more, "raw_oof_probability double, _label int"))
    data = VectorAssembler(inputCols=["x"], outputCol="v").transform(spark.createDataFrame(rows, "x double, y int"))
    want = LogisticRegression(featuresCol="v", labelCol="y", regParam=1 / len(rows), elasticNetParam=0.0, standardization=False,
                              maxIter=500, tol=1e-12).fit(data)
    assert line.coefficients[0] == pytest.approx(want.coefficients[0], abs=1e-6)
    assert line.intercept == pytest.approx(want.intercept, abs=1e-6)


def test_platt_of_nothing(spark):
    line = RK.fit_platt(spark.createDataFrame([], "raw_oof_probability double, _label int"))
    assert (line.coefficients[0], line.intercept) == (0.0, 0.0)
