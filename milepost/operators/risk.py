"""Stacked, calibrated delay-risk model.

Stack: OOF route material-delay rate + OOF stage-routed ETA (cross-fitted,
H10) -> risk features (F15) -> five fold classifiers give raw OOF
probabilities -> Platt calibration (logistic regression on the raw
probability) -> final classifier on all fit rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.config import RISK_LEVEL_EDGES, RISK_LEVELS, Config
from milepost.functions.expr import fold_of, right_closed_bin
from milepost.operators import boosting, crossfit, encode
from milepost.operators.eta import eta_oof, fit_eta, run_folds, sharing, sized
from milepost.operators.features import (
    CATEGORICAL, RISK_COLUMNS, TYPICAL, Preprocessor, fit_preprocessor, risk_feature_frame,
)
from milepost.session import cut_lineage

RATE = "route_material_delay_rate"
ROUTED = "stage_routed_predicted_final_delay_hours"
RISK_OUTPUT = ("risk_raw_probability", "risk_probability", "risk_level",
               "predicted_material_delay")


def gbt_classifier(cfg: Config, features: str, label: str) -> GBTClassifier:
    p = cfg.structured
    return GBTClassifier(featuresCol=features, labelCol=label, maxIter=p.max_iter,
                         stepSize=p.step_size, maxDepth=p.max_depth,
                         minInstancesPerNode=p.min_instances_per_node, maxBins=p.max_bins,
                         subsamplingRate=1.0, featureSubsetStrategy="all", seed=cfg.seed,
                         checkpointInterval=10)


@dataclass
class Classifier:
    prep: Preprocessor
    model: GBTClassificationModel

    def score(self, df: DataFrame, out: str) -> DataFrame:
        vec, prob = f"_vec_{out}", f"_prob_{out}"
        m = self.model.copy()
        m.setFeaturesCol(vec).setProbabilityCol(prob).setRawPredictionCol(f"_raw_{out}") \
            .setPredictionCol(f"_pred_{out}")
        scored = m.transform(self.prep.transform(df, vec))
        return (scored.withColumn(out, vector_to_array(F.col(prob))[1])
                .drop(vec, prob, f"_raw_{out}", f"_pred_{out}"))


def fit_classifier(train: DataFrame, cfg: Config, label: str = "_label",
                   prep: Preprocessor | None = None) -> Classifier:
    train = train.select(*RISK_COLUMNS, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        prep = prep or fit_preprocessor(train, RISK_COLUMNS, output_col="_vec")
        n = train.count()
        model = boosting.boosted(gbt_classifier(cfg, "_vec", "_y"), train, label, prep, n,
                                 lambda data: sized(data, n, cfg.structured.beside))
    finally:
        train.unpersist()
    return Classifier(prep, model)


class PlattLine(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted line of I4; as a stage it adds the calibrated probability."""

    slope = Param(Params._dummy(), "slope", "of the line", TypeConverters.toFloat)
    offset = Param(Params._dummy(), "offset", "of the line", TypeConverters.toFloat)
    inputCol = Param(Params._dummy(), "inputCol", "raw probability", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "calibrated probability", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, slope=1.0, offset=0.0, inputCol="risk_raw_probability", outputCol="risk_probability"):
        super().__init__()
        self._set(slope=slope, offset=offset, inputCol=inputCol, outputCol=outputCol)

    @property
    def coefficients(self) -> list[float]:
        return [self.getOrDefault("slope")]

    @property
    def intercept(self) -> float:
        return self.getOrDefault("offset")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return calibrate(self, dataset, self.getOrDefault("inputCol"), self.getOrDefault("outputCol"))


def fit_platt(raw_oof: DataFrame, prob: str = "raw_oof_probability",
              label: str = "_label", steps: int = 50) -> PlattLine:
    """I4: C=1 logistic regression of the label on the raw probability (the slope is
    penalised, the intercept isn't).  Rows shrink to counts per (score, label) once; each
    Newton step is one aggregate of five sums over them and a 2 x 2 system.  A step that
    does not lower the loss is halved."""
    x, y = F.col(prob).cast("double"), F.col(label).cast("double")
    counts = cut_lineage(raw_oof.select(x.alias("_s"), y.alias("_y")).where("_s IS NOT NULL AND _y IS NOT NULL")
                         .groupBy("_s", "_y").agg(F.count(F.lit(1)).cast("double").alias("_n")))

    def at(w: float, b: float):
        z = F.col("_s") * w + b
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        slack = F.col("_n") * (p - F.col("_y"))
        curve = F.col("_n") * p * (1 - p)
        loss = F.col("_n") * (F.greatest(z, F.lit(0.0)) - z * F.col("_y") + F.log1p(F.exp(-F.abs(z))))
        r = counts.agg(F.sum(loss).alias("loss"), F.sum(slack).alias("g0"), F.sum(slack * F.col("_s")).alias("g1"),
                       F.sum(curve).alias("h00"), F.sum(curve * F.col("_s")).alias("h01"),
                       F.sum(curve * F.col("_s") * F.col("_s")).alias("h11")).first()
        return None if r["loss"] is None else (r["loss"] + w * w / 2, r["g0"], r["g1"] + w, r["h00"], r["h01"], r["h11"] + 1)

    w = b = 0.0
    now = at(w, b)
    for _ in range(steps if now else 0):
        _, g0, g1, h00, h01, h11 = now
        det = h00 * h11 - h01 * h01
        if det <= 0:
            break
        dw, db = (h00 * g1 - h01 * g0) / det, (h11 * g0 - h01 * g1) / det
        then = at(w - dw, b - db)
        while then[0] > now[0] * (1 + 1e-12) and max(abs(dw), abs(db)) > 1e-12:
            dw, db = dw / 2, db / 2
            then = at(w - dw, b - db)
        w, b, now = w - dw, b - db, then
        if max(abs(dw), abs(db)) < 1e-10:
            break
    return PlattLine(slope=w, offset=b)


def calibrate(platt: PlattLine, df: DataFrame, raw: str, out: str) -> DataFrame:
    """Raw -> calibrated probability (sigmoid of the fitted line)."""
    return df.withColumn(out, sigmoid_of_line(raw, float(platt.coefficients[0]), float(platt.intercept)))


def sigmoid_of_line(raw: str, w: float, b: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(w) * F.col(raw) + F.lit(b))))


def risk_level(prob: str = "risk_probability") -> Column:
    """(-0.01, .35] LOW, (.35, .65] MEDIUM, (.65, 1] HIGH; else NULL."""
    return right_closed_bin(prob, RISK_LEVEL_EDGES, RISK_LEVELS)


def risk_alert(prob: str = "risk_probability", threshold: float = 0.29) -> Column:
    """I8: probability >= threshold; NULL and NaN -> false."""
    return F.coalesce((F.col(prob) >= F.lit(threshold)) & ~F.isnan(prob), F.lit(False))


@dataclass
class RiskModels:
    classifier: Classifier
    platt: PlattLine
    raw_oof: DataFrame


def risk_training_frame(train_rows: DataFrame, train_shipments: DataFrame, cfg: Config,
                        level: int = 0, checkpoint: bool = True,
                        store: crossfit.FoldStore | None = None) -> DataFrame:
    """I1 + I2 on fit rows: OOF typical, OOF route rate, OOF routed ETA -> F15."""
    salt = cfg.fold_salt(level)
    rows = train_rows.withColumn("_is_member", F.lit(True))
    r = encode.oof_typical(rows, train_rows, cfg.folds, salt, out=TYPICAL,
                           member_col="_is_member")
    r = encode.oof_route_rate(r, train_shipments, cfg.folds, salt, out=RATE,
                              member_col="_is_member", threshold=cfg.material_delay_hours)
    eta = eta_oof(train_rows, train_shipments, cfg, level, store).select(
        "snapshot_id", F.col("predicted_final_delay_hours").alias(ROUTED))
    r = r.join(eta, "snapshot_id", "left")
    feats = risk_feature_frame(r, keep=("snapshot_id", "shipment_id", "target_is_materially_delayed"),
                               threshold=cfg.material_delay_hours)
    feats = feats.withColumn("_label", F.col("target_is_materially_delayed").cast("int")) \
                 .withColumn("_fold", fold_of("shipment_id", salt, cfg.folds))
    return cut_lineage(feats) if checkpoint else feats


RISK_NUMERIC = [c for c in RISK_COLUMNS if c not in CATEGORICAL]


def raw_oof_probabilities(frame: DataFrame, cfg: Config, preps: dict | None = None,
                          store: crossfit.FoldStore | None = None, level: int = 0) -> DataFrame:
    """One classifier per fold, each scoring only its held fold."""
    store = store or crossfit.FoldStore(frame.sparkSession)
    preps = preps or crossfit.fold_preprocessors(frame, cfg.folds, RISK_NUMERIC, fold="_fold")

    def one_fold(k: int) -> DataFrame:
        def made() -> DataFrame:
            clf = fit_classifier(frame.where(F.col("_fold") != k), sharing(cfg, cfg.folds), prep=crossfit.only(preps[k, "all"], RISK_COLUMNS))
            return (clf.score(frame.where(F.col("_fold") == k), "raw_oof_probability")
                    .select("snapshot_id", "shipment_id", "_fold", "_label", "raw_oof_probability"))

        return store.keep(level, k, "risk", made)

    parts = run_folds(one_fold, cfg.folds, cfg.parallel_fits)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fit_risk_stack(train_rows: DataFrame, train_shipments: DataFrame,
                   prediction_rows: DataFrame, prediction_eta: DataFrame,
                   cfg: Config | None = None, level: int = 0,
                   checkpoint: bool = True,
                   store: crossfit.FoldStore | None = None) -> tuple[RiskModels, DataFrame]:
    """I1-I8.  ``prediction_eta`` = prediction rows + ETA columns (from fit_eta)."""
    cfg = cfg or Config()
    store = store or crossfit.FoldStore(train_rows.sparkSession)
    frame = risk_training_frame(train_rows, train_shipments, cfg, level, checkpoint, store)
    preps = crossfit.fold_preprocessors(frame, cfg.folds, RISK_NUMERIC, fold="_fold")
    # the final classifier doesn't wait for those of the folds
    raw, final = run_folds(lambda i: (
        lambda: raw_oof_probabilities(frame, cfg, preps, store, level),
        lambda: fit_classifier(frame, sharing(cfg, cfg.folds + 1), prep=crossfit.only(preps[crossfit.NONE, "all"], RISK_COLUMNS)))[i](),
        2, cfg.parallel_fits)
    platt = fit_platt(raw)
    # prediction side: full-fit typical and rate, routed ETA from the ETA pass
    rs, st = encode.typical_fit(train_rows)
    p = encode.map_typical(prediction_eta, rs, st, out=TYPICAL)
    p = encode.route_rate(train_shipments, p, out=RATE, threshold=cfg.material_delay_hours)
    p = p.withColumn(ROUTED, F.col("predicted_final_delay_hours"))
    keep = tuple(c for c in prediction_eta.columns)
    feats = risk_feature_frame(p, keep=keep, threshold=cfg.material_delay_hours)
    scored = final.score(feats, "risk_raw_probability")
    scored = calibrate(platt, scored, "risk_raw_probability", "risk_probability")
    scored = scored.withColumns({
        "risk_level": risk_level(),
        "predicted_material_delay": risk_alert(threshold=cfg.risk_threshold),
    })
    return RiskModels(final, platt, raw), scored.select(*keep, *RISK_OUTPUT)


def eta_with_folds(train_rows: DataFrame, train_shipments: DataFrame, prediction_rows: DataFrame, cfg: Config,
                   store: crossfit.FoldStore | None = None):
    """Predictions of the ETA models, and a store that holds the cross-fit's folds: the
    two don't depend on each other, so their fits run side by side."""
    store = store or crossfit.FoldStore(train_rows.sparkSession)
    jobs = (lambda: fit_eta(train_rows, train_shipments, prediction_rows, cfg)[1],
            lambda: eta_oof(train_rows, train_shipments, cfg, 0, store))
    return run_folds(lambda i: jobs[i](), 2, cfg.parallel_fits)[0], store


def oof_contract(raw_oof: DataFrame, fit_rows: DataFrame) -> DataFrame:
    """One row: fit rows without an OOF value, values outside [0,1], NULLs."""
    missing = fit_rows.select("snapshot_id").join(raw_oof.select("snapshot_id"), "snapshot_id",
                                                 "left_anti").agg(F.count(F.lit(1)).alias("missing"))
    bad = raw_oof.agg(
        F.sum(F.col("raw_oof_probability").isNull().cast("int")).alias("nulls"),
        F.sum(((F.col("raw_oof_probability") < 0) | (F.col("raw_oof_probability") > 1))
              .cast("int")).alias("out_of_range"))
    return missing.crossJoin(bad)  # one row each
