"""Exact medians by group without gathering a group in one task.

Rows shrink to counts per (group, value) in one partially aggregated pass over the
rows, written once (cut_lineage); what follows works on that small table.  Where a
group has more than ``SORTED`` distinct values, edges taken from the values themselves
(their approximate quantiles) part them into ``RANGES`` ranges of about equally many
distinct values, whatever their spread; the ranges' totals tell which range holds the
middle rank, and only its values go on, to be parted again while they are too many.
What remains is sorted: at most ``SORTED`` distinct values of a group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.session import cut_lineage

RANGES = 1024
SORTED = 3 * RANGES
#: Rank error of the edges is the number of values over this.
ACCURACY = 20 * RANGES
#: Groups being parted whose edges (8 KB each) are broadcast; more are dealt by salt.
BROADCAST_GROUPS = 1000
SALTS = 32


def value_counts(rows: DataFrame, keys: Sequence[str], value: str | Column) -> DataFrame:
    """keys..., _v, _n: how often each value occurs in each group (_v NULL: missing)."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    return (rows.select(*keys, F.when(~F.isnan(v), v).alias("_v"))
            .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")))


def rolled_up(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts by fewer keys."""
    return counts.groupBy(*keys, "_v").agg(F.sum("_n").alias("_n"))


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys, NULL equal to NULL; the right side's keys are dropped."""
    right = b.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in b.columns])
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(right[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return a.join(right, cond, how).drop(*[f"_r_{k}" for k in keys])


def _of_group(values: DataFrame, groups: DataFrame, g: Sequence[str], n_groups: int) -> DataFrame:
    """Values joined with their group's row; a group's values stay spread out."""
    if n_groups <= BROADCAST_GROUPS:
        return _same(values, F.broadcast(groups), g)
    salted = values.withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(SALTS)).cast("int"))
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return _same(salted, copies, [*g, "_salt"]).drop("_salt")


def range_of(v: Column, edges: Column, every32: Column) -> Column:
    """How many edges lie below v: whole 32s first, then within the 32 that follow."""
    whole = F.size(F.filter(every32, lambda e: e < v)) * 32
    return whole + F.size(F.filter(F.slice(edges, whole + 1, F.lit(32)), lambda e: e < v))


def _low(total: Column) -> Column:
    return F.floor((total - 1) / 2)


def _high(total: Column) -> Column:
    return F.floor(total / 2)


def middle_values(counts: DataFrame, g: Sequence[str], sorted_values: int = SORTED) -> DataFrame:
    """g..., _v, _n, _before, _total: for each group the values around its middle, at
    most ``sorted_values`` distinct ones, with the number of rows below them and in all."""
    active = counts.where(F.col("_v").isNotNull()).select(*g, "_v", "_n")
    edge = F.percentile_approx("_v", F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)]), F.lit(ACCURACY))
    done = None
    sizes = cut_lineage(active.groupBy(*g).agg(F.count(F.lit(1)).alias("_d"), F.sum("_n").alias("_total"))
                        .withColumn("_before", F.lit(0).cast("long")))
    while True:
        large = sizes.where(F.col("_d") > sorted_values)
        n = large.count()
        small = sizes if n == 0 else sizes.where(F.col("_d") <= sorted_values)
        part = _same(active, small.drop("_d"), g)
        done = part if done is None else done.unionByName(part)
        if n == 0:
            return done
        values = _of_group(active, large.select(*g), g, n)
        edges = cut_lineage(values.groupBy(*g).agg(F.sort_array(edge).alias("_edges")).withColumn(
            "_every32", F.filter("_edges", lambda e, i: i % 32 == 31)))
        cut = _of_group(values, edges, g, n).withColumn(
            "_b", range_of(F.col("_v"), F.col("_edges"), F.col("_every32"))).drop("_edges", "_every32")
        ranges = _same(cut.groupBy(*g, "_b").agg(F.sum("_n").alias("_bn"), F.count(F.lit(1)).alias("_bd")),
                       large.drop("_d"), g)
        ranges = ranges.withColumn("_before", F.col("_before") + F.sum("_bn").over(
            Window.partitionBy(*g).orderBy("_b")) - F.col("_bn"))
        middle = cut_lineage(
            ranges.where((F.col("_before") <= _high(F.col("_total"))) & (F.col("_before") + F.col("_bn") > _low(F.col("_total"))))
            .groupBy(*g).agg(F.min("_b").alias("_from"), F.max("_b").alias("_to"), F.sum("_bd").alias("_d"),
                             F.min("_before").alias("_before"), F.max("_total").alias("_total")))
        active = cut_lineage(_of_group(cut, middle.select(*g, "_from", "_to"), g, n)
                             .where(F.col("_b").between(F.col("_from"), F.col("_to"))).select(*g, "_v", "_n"))
        sizes = middle.select(*g, "_d", "_total", "_before")


def median_of_counts(counts: DataFrame, keys: Sequence[str], out: str, sorted_values: int = SORTED) -> DataFrame:
    """One row per group of ``counts`` (see value_counts): its median, the mean of
    the two middle values where the count is even, NULL without a value.  Without
    keys there is always one row."""
    g = list(keys) or ["_all"]
    inside = middle_values(counts if keys else counts.withColumn("_all", F.lit(0)), g, sorted_values)
    end = F.col("_before") + F.sum("_n").over(Window.partitionBy(*g).orderBy("_v"))
    at = inside.withColumn("_end", end)

    def holds(rank: Column) -> Column:
        return F.max(F.when((F.col("_end") > rank) & (F.col("_end") - F.col("_n") <= rank), F.col("_v")))

    mid = F.when(F.col("_a") == F.col("_z"), F.col("_a")).otherwise(F.col("_a") * 0.5 + F.col("_z") * 0.5)
    found = at.groupBy(*keys).agg(holds(_low(F.col("_total"))).alias("_a"), holds(_high(F.col("_total"))).alias("_z")) \
        .select(*keys, mid.alias(out))
    return _same(counts.select(*keys).distinct(), found, keys, "left") if keys else found


def grouped_median(rows: DataFrame, keys: Sequence[str], value: str | Column, out: str) -> DataFrame:
    """Median of ``value`` for each group of ``rows``."""
    return median_of_counts(cut_lineage(value_counts(rows, keys, value)), keys, out)


def grouped_medians(rows: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Medians of several columns, one row per group of ``rows`` (one row in all
    without keys); the columns are counted in one pass."""
    long = rows.select(*keys, F.inline(F.array(*[F.struct(
        F.lit(i).alias("_c"), F.col(v).cast("double").alias("_x")) for i, v in enumerate(values)])))
    counts = cut_lineage(value_counts(long, [*keys, "_c"], "_x"))
    med = median_of_counts(counts, [*keys, "_c"], "_m")
    return med.groupBy(*keys).agg(*[F.max(F.when(F.col("_c") == i, F.col("_m"))).alias(v) for i, v in enumerate(values)])
