"""Lookup fits and leave-fold-out (out-of-fold) target encoders.

F6/F7  typical latest delay by (route, stage) with a per-stage fallback
F8     generic OOF encoder: a row of fold k gets the statistic fitted on the
       shipments of the *other* folds; non-members get NULL
F9     OOF typical deviation
G1/I1  full-fit route median / route material-delay rate with overall fallback

Complement statistics never loop over folds and never copy fact rows:
* mean / rate: per-(fold, key) sums -> complement = (total - fold) / (N - n);
* median: counts per (fold, key, value), summed over the other folds, then the
  exact median of the counts (operators.quantile).
Lookups join through operators.lookup: broadcast below a counted bound, salted
beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.config import MATERIAL_DELAY_HOURS
from milepost.functions.expr import fold_of, latest_observed
from milepost.operators.lookup import lookup_join
from milepost.operators.quantile import median_of_counts, rolled_up, value_counts
from milepost.session import cut_lineage


def _has_keys(keys: Sequence[str]) -> Column:
    """A row belongs to a group only if none of its keys is NULL."""
    cond = F.lit(True)
    for c in keys:
        cond = cond & F.col(c).isNotNull()
    return cond


def full_fit_lookup(fit: DataFrame, rows: DataFrame, keys: Sequence[str], value: str,
                    how: str = "median", out: str = "encoded") -> DataFrame:
    """rows + ``out`` = statistic of ``value`` by ``keys`` over ``fit``; unknown or
    NULL key -> statistic over all of ``fit``."""
    keys = list(keys)
    if how == "median":
        counts = cut_lineage(value_counts(fit, keys, value))
        by_key = median_of_counts(counts.where(_has_keys(keys)), keys, "_by_key")
        overall = median_of_counts(rolled_up(counts, []), [], "_overall")
    elif how == "mean":
        sums = cut_lineage(fit.groupBy(*keys).agg(F.sum(value).alias("_s"), F.count(value).alias("_n")))
        by_key = sums.where(_has_keys(keys)).select(
            *keys, F.try_divide(F.col("_s"), F.col("_n").cast("double")).alias("_by_key"))
        overall = sums.agg(F.try_divide(F.sum("_s"), F.sum("_n").cast("double")).alias("_overall"))
    else:
        raise ValueError(how)
    return (lookup_join(rows, by_key, keys)
            .crossJoin(F.broadcast(overall))  # one row
            .withColumn(out, F.coalesce("_by_key", "_overall").cast("double"))
            .drop("_by_key", "_overall"))


def _membership(rows: DataFrame, fit_ids: DataFrame, member_col: str | None) -> DataFrame:
    if member_col is not None:
        return rows.withColumn("_member", F.col(member_col))
    ids = fit_ids.select("shipment_id").distinct().withColumn("_member", F.lit(True))
    return rows.join(ids, "shipment_id", "left").withColumn(
        "_member", F.coalesce("_member", F.lit(False)))


def _held_out_counts(counts: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Counts per (fold, keys, value) -> per (fold, keys, value) of the *other* folds."""
    other = F.explode(F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda h: h != F.col("_fold")))
    return (counts.select(*keys, "_v", "_n", other.alias("_hold"))
            .groupBy("_hold", *keys, "_v").agg(F.sum("_n").alias("_n"))
            .withColumnRenamed("_hold", "_fold"))


def oof_encode(rows: DataFrame, fit: DataFrame, keys: Sequence[str], value: str,
               k: int, salt: str, how: str = "median", out: str = "oof_encoded",
               member_col: str | None = None) -> DataFrame:
    """F8: leave-fold-out statistic of ``value`` by ``keys``.

    ``fit`` holds one row per fit shipment (shipment_id, keys..., value); the
    fallback is the statistic over the whole complement, not over all rows."""
    keys = list(keys)
    f = fit.withColumn("_fold", fold_of("shipment_id", salt, k))
    r = _membership(rows, fit, member_col).withColumn("_fold", fold_of("shipment_id", salt, k))
    if how == "mean":
        # complement = (key total - fold part) / (key count - fold count)
        sums = cut_lineage(f.groupBy("_fold", *keys).agg(F.sum(value).alias("_s"), F.count(value).alias("_n")))
        per = sums.where(_has_keys(keys))
        tot = per.groupBy(*keys).agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
        pf = sums.groupBy("_fold").agg(F.sum("_s").alias("_fs"), F.sum("_n").alias("_fn"))  # <= k rows
        everything = pf.agg(F.sum("_fs").alias("_as"), F.sum("_fn").alias("_an"))  # one row
        res = (lookup_join(lookup_join(r, tot, keys), per, ["_fold", *keys])
               .join(F.broadcast(pf), "_fold", "left")
               .crossJoin(F.broadcast(everything)))
        by_key = F.try_divide(F.col("_ts") - F.coalesce("_s", F.lit(0.0)),
                              (F.col("_tn") - F.coalesce("_n", F.lit(0))).cast("double"))
        overall = F.try_divide(F.col("_as") - F.coalesce("_fs", F.lit(0.0)),
                               (F.col("_an") - F.coalesce("_fn", F.lit(0))).cast("double"))
        return (res.withColumn(out, F.when(F.col("_member"), F.coalesce(by_key, overall)).cast("double"))
                .drop("_s", "_n", "_ts", "_tn", "_fs", "_fn", "_as", "_an", "_fold", "_member"))
    counts = cut_lineage(value_counts(f, ["_fold", *keys], value))
    others = _held_out_counts(counts.where(_has_keys(keys)), keys, k)
    by_key = median_of_counts(others, ["_fold", *keys], "_by_key")
    everyone = _held_out_counts(rolled_up(counts, ["_fold"]), [], k)
    overall = median_of_counts(everyone, ["_fold"], "_overall")  # <= k rows
    res = (lookup_join(r, by_key, ["_fold", *keys])
           .join(F.broadcast(overall), "_fold", "left"))
    return (res.withColumn(out, F.when(F.col("_member"), F.coalesce("_by_key", "_overall"))
                           .cast("double"))
            .drop("_by_key", "_overall", "_fold", "_member"))


# --- G1 / I1 ---------------------------------------------------------------

def route_median(fit_shipments: DataFrame, rows: DataFrame, out: str = "route_median_prediction") -> DataFrame:
    """G1: median final delay per route over fit shipments; unknown -> overall."""
    return full_fit_lookup(fit_shipments.select("route", "final_delay_hours"), rows,
                           ["route"], "final_delay_hours", "median", out)


def _material(threshold: float) -> Column:
    """A missing delay is not a material one (it counts as 0)."""
    return F.coalesce(F.col("final_delay_hours") > F.lit(threshold), F.lit(False)).cast("double")


def route_rate(fit_shipments: DataFrame, rows: DataFrame, out: str = "route_material_delay_rate",
               threshold: float = MATERIAL_DELAY_HOURS) -> DataFrame:
    """I1 (prediction rows): share of fit shipments with final delay > threshold."""
    fit = fit_shipments.select("route", _material(threshold).alias("_m"))
    return full_fit_lookup(fit, rows, ["route"], "_m", "mean", out)


def oof_route_median(rows: DataFrame, fit_shipments: DataFrame, k: int, salt: str,
                     out: str = "route_prior_final_delay", member_col: str | None = None) -> DataFrame:
    fit = fit_shipments.select("shipment_id", "route", "final_delay_hours")
    return oof_encode(rows, fit, ["route"], "final_delay_hours", k, salt, "median", out,
                      member_col)


def oof_route_rate(rows: DataFrame, fit_shipments: DataFrame, k: int, salt: str,
                   out: str = "route_material_delay_rate", member_col: str | None = None,
                   threshold: float = MATERIAL_DELAY_HOURS) -> DataFrame:
    fit = fit_shipments.select("shipment_id", "route", _material(threshold).alias("_m"))
    return oof_encode(rows, fit, ["route"], "_m", k, salt, "mean", out, member_col)


# --- F5-F7, F9 -------------------------------------------------------------

def typical_fit(rows: DataFrame):
    """(route x stage medians, stage medians) of the latest observed delay."""
    lat = rows.select("route", "snapshot_stage", latest_observed().alias("_latest"))
    counts = cut_lineage(value_counts(lat.where(F.col("snapshot_stage").isNotNull()),
                                      ["route", "snapshot_stage"], "_latest"))
    rs = median_of_counts(counts.where(F.col("route").isNotNull()), ["route", "snapshot_stage"], "typical_route_stage")
    return rs, median_of_counts(rolled_up(counts, ["snapshot_stage"]), ["snapshot_stage"], "typical_stage")


def map_typical(rows: DataFrame, route_stage: DataFrame, stage: DataFrame,
                out: str = "observed_delay_vs_route_typical") -> DataFrame:
    """latest - coalesce(route x stage typical, stage typical)."""
    return (lookup_join(rows, route_stage, ["route", "snapshot_stage"])
            .join(F.broadcast(stage), "snapshot_stage", "left")  # one row per stage
            .withColumn(out, latest_observed() - F.coalesce("typical_route_stage", "typical_stage"))
            .drop("typical_route_stage", "typical_stage"))


def oof_typical(rows: DataFrame, fit_rows: DataFrame, k: int, salt: str,
                out: str = "observed_delay_vs_route_typical", member_col: str | None = None) -> DataFrame:
    """F6/F7 fitted on the snapshots of complement-fold shipments.

    ``fit_rows`` are the snapshots of fit shipments; membership of a row means
    its shipment is a fit shipment."""
    f = (fit_rows.select("shipment_id", "route", "snapshot_stage", latest_observed().alias("_latest"))
         .withColumn("_fold", fold_of("shipment_id", salt, k)))
    known = f.where(F.col("snapshot_stage").isNotNull())
    pair = ["route", "snapshot_stage"]
    counts = cut_lineage(value_counts(known, ["_fold", *pair], "_latest"))
    rs = median_of_counts(_held_out_counts(counts.where(F.col("route").isNotNull()), pair, k), ["_fold", *pair], "_rs")
    per_stage = _held_out_counts(rolled_up(counts, ["_fold", "snapshot_stage"]), ["snapshot_stage"], k)
    st = median_of_counts(per_stage, ["_fold", "snapshot_stage"], "_st")
    r = _membership(rows, fit_rows, member_col).withColumn("_fold", fold_of("shipment_id", salt, k))
    res = (lookup_join(r, rs, ["_fold", *pair])
           .join(F.broadcast(st), ["_fold", "snapshot_stage"], "left"))  # folds x stages
    return (res.withColumn(out, F.when(F.col("_member"),
                                       latest_observed() - F.coalesce("_rs", "_st")))
            .drop("_rs", "_st", "_fold", "_member"))
