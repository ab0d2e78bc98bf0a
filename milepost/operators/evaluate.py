"""Evaluation aggregates.

Scopes are ALL plus each stage: the rows are aggregated by stage once, and the
few resulting rows are rolled up to ALL.
Average precision needs a cumulative sum in score order; instead of one global
window it takes offsets from the totals of score ranges (a bounded histogram) and
runs the sum only inside (scope, range).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.config import METHODS, RISK_METHOD, RISK_THRESHOLD, STAGES
from milepost.operators.quantile import range_of
from milepost.session import cut_lineage

# Calibration bin edges as produced by numpy linspace(0, 1, 6)
# and the labels pandas prints for them (first bin closed at 0).
CALIBRATION_EDGES = (0.0, 0.2, 0.4, 0.6000000000000001, 0.8, 1.0)
CALIBRATION_LABELS = ("(-0.001, 0.2]", "(0.2, 0.4]", "(0.4, 0.6]", "(0.6, 0.8]", "(0.8, 1.0]")

#: Ranges the distinct scores are cut into for running sums: the largest of so many
#: random ranges holds some 0.2 % of them.
SCORE_RANGES = 4096


def _scoped(df: DataFrame, stages=STAGES) -> DataFrame:
    """Each row in scope ALL and in its own stage (2 copies, aggregated map-side)."""
    return df.withColumn("scope", F.explode(F.array(F.lit("ALL"), F.col("snapshot_stage")))) \
             .where(F.col("scope").isin("ALL", *stages))


def scope_dimension(spark, stages=STAGES) -> DataFrame:
    return spark.createDataFrame([(s, i) for i, s in enumerate(("ALL",) + tuple(stages))],
                                 "scope string, scope_order int")


def method_dimension(spark, methods=METHODS) -> DataFrame:
    return spark.createDataFrame([(m, i) for i, m in enumerate(methods)],
                                 "method string, method_order int")


def regression_metrics(rows: DataFrame, prediction_cols: dict, stages=STAGES,
                       target: str = "target_final_delay_hours") -> DataFrame:
    """N, MAE, RMSE per (method, scope) over rows whose prediction is not
    NULL; empty scopes are omitted.  ``prediction_cols``: method -> column."""
    spark = rows.sparkSession
    y, sums = F.col(target).cast("double"), []
    for i, c in enumerate(prediction_cols.values()):
        p = F.col(c).cast("double")
        e = p - y
        sums += [F.count(p).alias(f"_n{i}"), F.count(e).alias(f"_k{i}"),
                 F.sum(F.abs(e)).alias(f"_a{i}"), F.sum(e * e).alias(f"_s{i}")]
    per_stage = rows.groupBy("snapshot_stage").agg(*sums)  # a row per stage
    long = per_stage.select("snapshot_stage", F.inline(F.array(*[
        F.struct(F.lit(m).alias("method"), *[F.col(f"_{x}{i}").alias(f"_{x}") for x in "nkas"])
        for i, m in enumerate(prediction_cols)])))
    agg = (_scoped(long, stages).groupBy("method", "scope")
           .agg(F.sum("_n").cast("bigint").alias("n_snapshots"),
                F.try_divide(F.sum("_a"), F.sum("_k").cast("double")).alias("mae_hours"),
                F.sqrt(F.try_divide(F.sum("_s"), F.sum("_k").cast("double"))).alias("rmse_hours"))
           .where(F.col("n_snapshots") > 0))
    order = (F.broadcast(method_dimension(spark, tuple(prediction_cols))),
             F.broadcast(scope_dimension(spark, stages)))
    return (agg.join(order[0], "method").join(order[1], "scope")
            .orderBy("method_order", "scope_order")
            .select("method", "scope", "n_snapshots", "mae_hours", "rmse_hours"))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    d = 2 * tp + fp + fn
    return F.when(d == 0, F.lit(0.0)).otherwise((2 * tp).cast("double") / d)


def score_counts(rows: DataFrame, prob: str, label: str) -> DataFrame:
    """snapshot_stage, _p, _y, _n: all that the risk metrics need, in one partially
    aggregated pass (a NaN score is a missing one)."""
    p = F.col(prob).cast("double")
    return (rows.select("snapshot_stage", F.when(~F.isnan(p), p).alias("_p"), F.col(label).cast("int").alias("_y"))
            .groupBy("snapshot_stage", "_p", "_y").agg(F.count(F.lit(1)).alias("_n")))


def classification_counts(counts: DataFrame, threshold: float, stages=STAGES) -> DataFrame:
    pred = F.coalesce(F.col("_p") >= F.lit(threshold), F.lit(False))
    p, y, n = F.col("_p"), F.col("_y"), F.col("_n")

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, n).otherwise(F.lit(0)))
    return _scoped(counts, stages).groupBy("scope").agg(
        F.sum("_n").cast("bigint").alias("n_snapshots"),
        total(pred & (y == 1)).alias("tp"), total(pred & (y == 0)).alias("fp"),
        total(~pred & (y == 1)).alias("fn"),
        F.try_divide(F.sum((p - y) * (p - y) * n), total((p - y).isNotNull()).cast("double")).alias("brier_score"),
    )


def precision_recall_f1(rows: DataFrame, prob: str = "risk_probability",
                        label: str = "target_is_materially_delayed",
                        threshold: float = RISK_THRESHOLD, stages=STAGES) -> DataFrame:
    """J2 (+J4): precision, recall, F1 at the threshold per scope; 0/0 = 0."""
    return _precision_recall(score_counts(rows, prob, label), threshold, stages)


def _precision_recall(counts: DataFrame, threshold: float, stages) -> DataFrame:
    c = classification_counts(counts, threshold, stages)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        "scope", "n_snapshots",
        F.coalesce(F.try_divide(tp.cast("double"), (tp + fp).cast("double")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp.cast("double"), (tp + fn).cast("double")), F.lit(0.0)).alias("recall"),
        _f1(tp, fp, fn).alias("f1"), "brier_score")


def average_precision(rows: DataFrame, prob: str = "risk_probability",
                      label: str = "target_is_materially_delayed", stages=STAGES,
                      ranges: int = SCORE_RANGES) -> DataFrame:
    """AP = sum over distinct scores (desc) of (R_i - R_{i-1}) * P_i, tied
    scores one step.  NULL if a scope has no positives.

    A prefix sum over ranges of scores: each range's totals, added up over the higher
    ranges, give its offset, and the running sum is only taken inside (scope, range).
    The plan is lazy throughout: no job runs before an action."""
    return _average_precision(score_counts(rows, prob, label), stages, ranges)


def _score_edges(scores: DataFrame, ranges: int) -> DataFrame:
    """One row: at most ``ranges`` of the distinct scores, ascending.  Of the scores that
    hash to one number, the one with the smallest second hash: an even sample of the
    distinct scores, wherever they cluster, that comes out the same in every run."""
    sample = scores.groupBy(F.pmod(F.xxhash64("_p"), F.lit(ranges)).alias("_h")).agg(
        F.min_by("_p", F.xxhash64("_p", F.lit(1))).alias("_e"))
    return sample.agg(F.sort_array(F.collect_list("_e")).alias("_edges")).withColumn(
        "_every32", F.filter("_edges", lambda e, i: i % 32 == 31))


def _average_precision(counts: DataFrame, stages, ranges: int = SCORE_RANGES) -> DataFrame:
    per_score = (_scoped(counts.where(F.col("_p").isNotNull()), stages).groupBy("scope", "_p")
                 .agg(F.sum(F.col("_y") * F.col("_n")).alias("_tp"), F.sum("_n").alias("_n")))
    keyed = (per_score.crossJoin(F.broadcast(_score_edges(per_score, ranges)))  # one row
             .withColumn("_b", range_of(F.col("_p"), F.col("_edges"), F.col("_every32")))
             .drop("_edges", "_every32"))
    hist = keyed.groupBy("scope", "_b").agg(F.sum("_tp").alias("_btp"), F.sum("_n").alias("_bn"))
    # <= scopes x (ranges + 1) rows
    w = Window.partitionBy("scope").orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = hist.select("scope", "_b",
                          F.coalesce(F.sum("_btp").over(w), F.lit(0)).alias("_otp"),
                          F.coalesce(F.sum("_bn").over(w), F.lit(0)).alias("_on"))
    wi = Window.partitionBy("scope", "_b").orderBy(F.col("_p").desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    cum = (keyed.join(F.broadcast(offsets), ["scope", "_b"])
           .withColumn("_ctp", F.col("_otp") + F.sum("_tp").over(wi))
           .withColumn("_cn", F.col("_on") + F.sum("_n").over(wi)))
    return (cum.groupBy("scope")
            .agg(F.sum(F.col("_tp") * (F.col("_ctp") / F.col("_cn"))).alias("_num"),
                 F.sum("_tp").alias("_pos"))
            .select("scope", F.when(F.col("_pos") > 0, F.col("_num") / F.col("_pos")).alias("pr_auc")))


def risk_metrics(rows: DataFrame, prob: str = "risk_probability",
                 label: str = "target_is_materially_delayed",
                 threshold: float = RISK_THRESHOLD, stages=STAGES,
                 method: str = RISK_METHOD) -> DataFrame:
    """J2-J4 in the published column order; empty scopes give n=0, NULL metrics."""
    spark = rows.sparkSession
    counts = cut_lineage(score_counts(rows, prob, label))
    prf = _precision_recall(counts, threshold, stages)
    ap = _average_precision(counts, stages)
    dim = F.broadcast(scope_dimension(spark, stages))
    return (dim.join(prf, "scope", "left").join(ap, "scope", "left")
            .orderBy("scope_order")
            .select(F.lit(method).alias("method"), F.lit(threshold).alias("threshold"),
                    F.coalesce("n_snapshots", F.lit(0).cast("bigint")).alias("n_snapshots"),
                    "precision", "recall", "f1", "pr_auc", "brier_score", "scope"))


def calibration_table(rows: DataFrame, prob: str = "risk_probability",
                      label: str = "target_is_materially_delayed") -> DataFrame:
    """5 equal right-closed bins (0 included); empty bins kept with n=0."""
    spark = rows.sparkSession
    p = F.col(prob)
    e = CALIBRATION_EDGES
    b = None
    for i, lab in enumerate(CALIBRATION_LABELS):
        cond = ((p >= e[0]) if i == 0 else (p > e[i])) & (p <= e[i + 1])
        b = F.when(cond, lab) if b is None else b.when(cond, lab)
    agg = (rows.select(b.alias("bin"), p.alias("_p"), F.col(label).cast("double").alias("_y"))
           .where(F.col("bin").isNotNull())
           .groupBy("bin").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                               F.avg("_p").alias("mean_predicted_probability"),
                               F.avg("_y").alias("observed_material_delay_rate")))
    dim = spark.createDataFrame([(lab, i) for i, lab in enumerate(CALIBRATION_LABELS)],
                                "bin string, bin_order int")
    return (F.broadcast(dim).join(agg, "bin", "left").orderBy("bin_order")
            .select("bin", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
                    "mean_predicted_probability", "observed_material_delay_rate"))


def headline(comparison: DataFrame, risk: DataFrame,
             routed: str = "Stage-routed v2 policy") -> DataFrame:
    """Routed ETA (ALL) and risk (ALL) headline metrics in one row."""
    eta = comparison.where((F.col("method") == routed) & (F.col("scope") == "ALL")).select(
        F.col("mae_hours").alias("eta_mae_hours"), F.col("rmse_hours").alias("eta_rmse_hours"))
    rk = risk.where(F.col("scope") == "ALL").select(
        F.col("pr_auc").alias("risk_pr_auc"), F.col("brier_score").alias("risk_brier_score"),
        F.col("f1").alias("risk_f1"))
    return eta.crossJoin(rk)  # one row each


def counts_by_stage(rows: DataFrame) -> DataFrame:
    """Snapshot counts by stage, sorted by stage name."""
    return (rows.groupBy("snapshot_stage").agg(F.count(F.lit(1)).cast("bigint").alias("n_snapshots"))
            .orderBy("snapshot_stage"))
