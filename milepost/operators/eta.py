"""Stage-routed, cross-fitted ETA models (Spark ML GBT).

``fit_eta`` trains four boosted-tree regressors (direct residual over all
stages; customs and post-customs deviation on S2; inland deviation on S3) and
returns a lazily scored prediction frame: scoring is a per-row expression, no
shuffle.  ``eta_oof`` cross-fits the whole of ``fit_eta`` over group folds and
unions the held-out predictions; nested encoders use the next salt level.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml.regression import GBTRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.config import Config, GBTPreset
from milepost.functions.time import add_hours, hours_between, iso_instant
from milepost.operators import boosting, crossfit, encode
from milepost.operators.features import (
    CATEGORICAL, INTERACTIONS, NUMERIC, PRIOR, S2_DROP, TYPICAL, Preprocessor,
    fit_preprocessor, interactions, v2_features, with_base_features,
)

#: Rows of a boosting task: as few as this where cores would be idle, as many where not.
ROWS_PER_TASK, MOST_ROWS_PER_TASK = 50_000, 400_000
S1, S2, S3 = "ORIGIN_DEPARTED", "PORT_ARRIVED", "CUSTOMS_CLEARED"
ETA_COLUMNS = (
    "direct_v2_predicted_final_delay_hours", "structured_v2_predicted_final_delay_hours",
    "predicted_customs_deviation_hours", "predicted_post_customs_deviation_hours",
    "predicted_inland_deviation_hours", "planned_customs_remaining_hours",
    "planned_post_customs_remaining_hours", "planned_inland_remaining_hours",
    "predicted_final_delay_hours", "selected_eta_model", "predicted_final_eta",
)
DIRECT_FEATURES = CATEGORICAL + NUMERIC + INTERACTIONS + [TYPICAL, PRIOR]
S3_FEATURES = CATEGORICAL + NUMERIC + INTERACTIONS + [TYPICAL]
S2_FEATURES = [c for c in S3_FEATURES if c not in S2_DROP]


def gbt_regressor(preset: GBTPreset, seed: int, features: str, label: str,
                  prediction: str) -> GBTRegressor:
    """Depth-3 trees, min 15 rows per leaf, no early stopping."""
    return GBTRegressor(featuresCol=features, labelCol=label, predictionCol=prediction,
                        maxIter=preset.max_iter, stepSize=preset.step_size,
                        maxDepth=preset.max_depth,
                        minInstancesPerNode=preset.min_instances_per_node,
                        maxBins=preset.max_bins, subsamplingRate=1.0,
                        featureSubsetStrategy="all", lossType="squared", seed=seed,
                        checkpointInterval=10)


@dataclass
class FittedModel:
    prep: Preprocessor
    model: GBTRegressionModel

    def score(self, df: DataFrame, out: str) -> DataFrame:
        vec = f"_vec_{out}"
        m = self.model.copy()
        m.setFeaturesCol(vec).setPredictionCol(out)
        return m.transform(self.prep.transform(df, vec)).drop(vec)


def _fit(train: DataFrame, columns, label: str, preset: GBTPreset, seed: int,
         prep: Preprocessor | None = None) -> FittedModel:
    """Fit on ``columns``; ``prep`` where the preparation is known already."""
    train = train.select(*columns, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        prep = prep or fit_preprocessor(train, columns, output_col="_vec")
        n = train.count()
        model = boosting.boosted(gbt_regressor(preset, seed, "_vec", "_label", "_pred"), train, label, prep, n,
                                 lambda data: sized(data, n, preset.beside))
    finally:
        train.unpersist()
    return FittedModel(prep, model)


def sized(data: DataFrame, n: int, beside: int = 1) -> DataFrame:
    """``data`` (n rows) in as few partitions as keep the cores busy that ``beside`` fits
    leave to each: boosting over several tasks runs some hundreds of small jobs, and each
    task of theirs builds, sends and adds up histograms of its own, whatever its rows."""
    share = max(1, data.sparkSession.sparkContext.defaultParallelism // beside)
    return data.coalesce(max(1, -(-n // MOST_ROWS_PER_TASK), min(-(-n // ROWS_PER_TASK), share)))


def sharing(cfg: Config, fits: int) -> Config:
    """cfg where each of ``fits`` models of one size is fitted beside the others."""
    beside = max(1, min(fits, cfg.parallel_fits))
    return replace(cfg, direct=replace(cfg.direct, beside=beside), structured=replace(cfg.structured, beside=beside))


def s2_targets(frame: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """H2: planned customs / post-customs remaining hours and, with ``truth``
    (fit shipments' actual instants), the customs and post-customs deviations."""
    f = frame.withColumns({
        "planned_customs_remaining_hours": hours_between("snapshot_at", "scheduled_customs_clearance_at"),
        "planned_post_customs_remaining_hours": hours_between("scheduled_customs_clearance_at",
                                                              "scheduled_final_eta"),
    })
    if truth is None:
        return f
    t = truth.select("shipment_id", F.col("actual_customs_clearance_at").alias("_ac"),
                     F.col("actual_final_delivery_at").alias("_af"))
    return s2_deviations(f.join(t, "shipment_id", "left")).drop("_ac", "_af")


def s2_deviations(frame: DataFrame) -> DataFrame:
    """Customs and post-customs deviation of rows that carry the planned hours and the
    actual instants (``_ac``, ``_af``)."""
    return frame.withColumns({
        "customs_deviation_hours": hours_between("snapshot_at", "_ac")
        - F.col("planned_customs_remaining_hours"),
        "post_customs_deviation_hours": hours_between("_ac", "_af")
        - F.col("planned_post_customs_remaining_hours"),
    })


def s3_targets(frame: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """H3: planned inland remaining hours and the inland deviation."""
    f = frame.withColumn("planned_inland_remaining_hours",
                         hours_between("snapshot_at", "scheduled_final_eta"))
    if truth is None:
        return f
    t = truth.select("shipment_id", F.col("actual_final_delivery_at").alias("_af"))
    return s3_deviations(f.join(t, "shipment_id", "left")).drop("_af")


def s3_deviations(frame: DataFrame) -> DataFrame:
    return frame.withColumn("inland_deviation_hours", hours_between("snapshot_at", "_af")
                            - F.col("planned_inland_remaining_hours"))


def waterfall_s2(planned_customs: Column, customs_dev: Column, planned_post: Column,
                 post_dev: Column) -> Column:
    """H6: (snap + planned customs + c + planned post + p) - scheduled final, hours."""
    eta = add_hours(F.col("snapshot_at"), planned_customs + customs_dev + planned_post + post_dev)
    return hours_between("scheduled_final_eta", eta)


def waterfall_s3(planned_inland: Column, inland_dev: Column) -> Column:
    """H7: (snap + planned inland + i) - scheduled final, hours."""
    eta = add_hours(F.col("snapshot_at"), planned_inland + inland_dev)
    return hours_between("scheduled_final_eta", eta)


def route_policy(policy: dict, stage: str = "snapshot_stage") -> Column:
    """H8: model label per stage from the policy map."""
    pairs = [F.lit(x) for kv in policy.items() for x in kv]
    return F.element_at(F.create_map(*pairs), F.col(stage))


def routed_delay(direct: str, structured: str, policy: dict) -> Column:
    label = route_policy(policy)
    return (F.when(label == "Direct HGB v2", F.col(direct))
            .when(label == "Structured HGB v2", F.col(structured)))


def predicted_eta(delay: str = "predicted_final_delay_hours") -> Column:
    """H9: scheduled final + predicted delay, ISO seconds (truncated)."""
    return iso_instant(add_hours(F.col("scheduled_final_eta"), F.col(delay)))


@dataclass
class EtaModels:
    direct: FittedModel
    customs: FittedModel
    post_customs: FittedModel
    inland: FittedModel


def with_eta_features(rows: DataFrame, fit_rows: DataFrame, fit_shipments: DataFrame,
                      cfg: Config, level: int, is_fit: bool) -> DataFrame:
    """Typical deviation + route prior: OOF on fit rows, full-fit on others."""
    salt = cfg.fold_salt(level)
    if is_fit:
        r = encode.oof_route_median(rows, fit_shipments, cfg.folds, salt, out=PRIOR,
                                    member_col="_is_member") \
            if "_is_member" in rows.columns else \
            encode.oof_route_median(rows, fit_shipments, cfg.folds, salt, out=PRIOR,
                                    )
        member = "_is_member" if "_is_member" in rows.columns else None
        return encode.oof_typical(r, fit_rows, cfg.folds, salt, out=TYPICAL,
                                  member_col=member)
    r = encode.route_median(fit_shipments, rows, out=PRIOR)
    rs, st = encode.typical_fit(fit_rows)
    return encode.map_typical(r, rs, st, out=TYPICAL)


def fit_eta(train_rows: DataFrame, train_shipments: DataFrame, prediction_rows: DataFrame,
            cfg: Config | None = None, level: int = 0) -> tuple[EtaModels, DataFrame]:
    """H1-H9.  Returns the models and ``prediction_rows`` + the 11 ETA columns."""
    cfg = cfg or Config()
    train = with_eta_features(train_rows.withColumn("_is_member", F.lit(True)), train_rows,
                              train_shipments, cfg, level, True).drop("_is_member")
    # the encoded fit rows feed four fits: materialise them once
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    pred = with_eta_features(prediction_rows, train_rows, train_shipments, cfg, level, False)
    s2 = s2_targets(train.where(F.col("snapshot_stage") == S2), train_shipments)
    s3 = s3_targets(train.where(F.col("snapshot_stage") == S3), train_shipments)
    try:
        models = fit_models(train, s2, s3, cfg)
    finally:
        train.unpersist()
    return models, predict_eta(models, pred, prediction_rows.columns, cfg)


def fit_models(train: DataFrame, s2: DataFrame, s3: DataFrame, cfg: Config,
               preps: dict[str, Preprocessor] | None = None) -> EtaModels:
    """The four models.  ``train`` carries PRIOR and TYPICAL, ``s2`` and ``s3`` its rows
    of these stages with their deviations; ``preps`` by subset where known already."""
    preps = preps or {}
    # H1 direct residual model over all stages
    direct_train = v2_features(train, True, keep=("snapshot_id", "target_final_delay_hours")) \
        .withColumn("_residual", F.col("target_final_delay_hours") - F.col(PRIOR))
    # H2-H5 structured models on stage subsets
    s2f = v2_features(s2, False, keep=("snapshot_id", "customs_deviation_hours",
                                       "post_customs_deviation_hours"))
    s3f = v2_features(s3, False, keep=("snapshot_id", "inland_deviation_hours"))
    jobs = [
        (direct_train, DIRECT_FEATURES, "_residual", cfg.direct, "all"),
        (s2f, S2_FEATURES, "customs_deviation_hours", cfg.structured, S2),
        (s2f, S2_FEATURES, "post_customs_deviation_hours", cfg.structured, S2),
        (s3f, S3_FEATURES, "inland_deviation_hours", cfg.structured, S3),
    ]

    def one(i: int) -> FittedModel:
        data, columns, label, preset, subset = jobs[i]
        prep = crossfit.only(preps[subset], columns) if preps else None
        return _fit(data, columns, label, preset, cfg.seed, prep)

    return EtaModels(*run_folds(one, len(jobs), cfg.parallel_fits))


def predict_eta(models: EtaModels, pred: DataFrame, keep_columns, cfg: Config) -> DataFrame:
    """Score prediction rows carrying PRIOR and TYPICAL (H1, H5-H9)."""
    feats = v2_features(pred, True, keep=tuple(keep_columns))
    scored = models.direct.score(feats, "_direct")
    scored = models.customs.score(scored, "_c")
    scored = models.post_customs.score(scored, "_p")
    scored = models.inland.score(scored, "_i")
    scored = s3_targets(s2_targets(scored))
    stage = F.col("snapshot_stage")
    is2, is3 = stage == S2, stage == S3
    c, p, i = (F.when(is2, F.col("_c")), F.when(is2, F.col("_p")), F.when(is3, F.col("_i")))
    pcr = F.when(is2, F.col("planned_customs_remaining_hours"))
    ppr = F.when(is2, F.col("planned_post_customs_remaining_hours"))
    pir = F.when(is3, F.col("planned_inland_remaining_hours"))
    out = scored.withColumns({
        "direct_v2_predicted_final_delay_hours": F.col("_direct") + F.col(PRIOR),
        "predicted_customs_deviation_hours": c,
        "predicted_post_customs_deviation_hours": p,
        "predicted_inland_deviation_hours": i,
        "planned_customs_remaining_hours": pcr,
        "planned_post_customs_remaining_hours": ppr,
        "planned_inland_remaining_hours": pir,
    }).withColumn("structured_v2_predicted_final_delay_hours",
                  F.when(is2, waterfall_s2(pcr, c, ppr, p)).when(is3, waterfall_s3(pir, i)))
    out = out.withColumn("predicted_final_delay_hours", routed_delay(
        "direct_v2_predicted_final_delay_hours", "structured_v2_predicted_final_delay_hours",
        cfg.eta_policy)).withColumn("selected_eta_model", route_policy(cfg.eta_policy))
    out = out.withColumn("predicted_final_eta", predicted_eta())
    return out.select(*keep_columns, *ETA_COLUMNS)


def run_folds(fn, k: int, parallel: int) -> list:
    """Run ``fn(fold)`` for every fold; independent fits may run concurrently
    (Spark schedules jobs from several driver threads)."""
    if parallel <= 1:
        return [fn(i) for i in range(k)]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(parallel, k)) as pool:
        return list(pool.map(fn, range(k)))


def fold_parts(rows: DataFrame, k: int, fold: str = crossfit.OUTER) -> tuple[DataFrame, DataFrame]:
    """What fold k is fitted on, and what it predicts (rows carry their fold)."""
    return rows.where(F.col(fold) != k).drop(fold), rows.where(F.col(fold) == k).drop(fold)


def eta_oof(rows: DataFrame, shipments: DataFrame, cfg: Config | None = None,
            level: int = 0, store: crossfit.FoldStore | None = None) -> DataFrame:
    """For each fold fit H1-H9 on the other folds (inner encoders re-folded
    with the next salt level) and predict the held fold; union the held parts.
    Returns (snapshot_id, shipment_id, predicted_final_delay_hours, fold).

    Encoders, imputers and levels of all folds come from one count (operators.crossfit);
    ``store`` keeps each fold's part, so that a run on the same folder fits what is missing."""
    cfg = cfg or Config()
    store = store or crossfit.FoldStore(rows.sparkSession)
    # folds run concurrently and share the fits they may have under way, so at
    # most ``parallel_fits`` training sets are cached at any time
    inner = replace(sharing(cfg, cfg.folds), parallel_fits=max(1, cfg.parallel_fits // cfg.folds))
    missing = [k for k in range(cfg.folds) if not store.has(level, k, "eta")]
    if missing:
        frame = store.keep(level, "all", "frame", lambda: crossfit.fold_frame(rows, shipments, cfg, level))
        preps = crossfit.fold_preprocessors(
            interactions(with_base_features(frame)), cfg.folds, NUMERIC + INTERACTIONS,
            {TYPICAL: "_typical", PRIOR: "_prior"},
            {"all": F.lit(True), **{s: F.col("snapshot_stage") == s for s in (S2, S3)}})

    def one_fold(k: int) -> DataFrame:
        def made() -> DataFrame:
            own = frame.withColumns({PRIOR: F.get("_prior", F.lit(k)), TYPICAL: F.get("_typical", F.lit(k))})
            fit_rows, held = fold_parts(own, k)
            models = fit_models(
                fit_rows, s2_deviations(s2_targets(fit_rows.where(F.col("snapshot_stage") == S2))),
                s3_deviations(s3_targets(fit_rows.where(F.col("snapshot_stage") == S3))), inner,
                {s: preps[k, s] for s in ("all", S2, S3)})
            return predict_eta(models, held, rows.columns, inner).select(
                "snapshot_id", "shipment_id", "predicted_final_delay_hours", F.lit(k).alias("fold"))

        return store.keep(level, k, "eta", made)

    parts = run_folds(one_fold, cfg.folds, cfg.parallel_fits)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
