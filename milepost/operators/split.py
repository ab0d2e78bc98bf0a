"""Grouped split with exact quotas, group folds, membership, leak check.

D1 never ranks the whole population in one task.  Ids are ordered by a 60-bit
md5 hash of ``seed:id`` (ties by id).  A histogram over the top ``bits`` of that
hash (at most 2^bits rows, so it is bounded by construction) gives every bucket
its starting offset; ids are then ranked only inside the buckets where one split
ends and the next begins (~N / 2^bits ids each, because the hash is uniform over
distinct ids).  The (hash, id) at these places decides any row's split by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.config import SEED, SPLIT_QUOTAS
from milepost.functions.expr import fold_of, md5_int

ORDER_HEX_DIGITS = 15  # 60-bit order hash: fits a signed bigint on every engine


def quota_counts(n: int, quotas=SPLIT_QUOTAS) -> list[tuple[str, int]]:
    """Exact quota sizes for a population of n (the last split takes the rest)."""
    total = sum(q for _, q in quotas)
    sizes = [(name, n * q // total) for name, q in quotas[:-1]]
    sizes.append((quotas[-1][0], n - sum(s for _, s in sizes)))
    return sizes


def split_bounds(shipments: DataFrame, seed: int = SEED, quotas=SPLIT_QUOTAS, bucket_bits: int = 16) -> DataFrame:
    """One row with ``_cut{i}`` for each split but the last: the (hash, id) that comes
    first after it in the order of all ids, NULL where none does.  Only the ids of a
    bucket that holds such a cut are ranked."""
    ids = shipments.select("shipment_id").where(F.col("shipment_id").isNotNull()).distinct()
    keyed = ids.select("shipment_id", _order_hash(seed).alias("_h")).withColumn(
        "_b", F.shiftright("_h", ORDER_HEX_DIGITS * 4 - bucket_bits).cast("int"))
    hist = keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    # <= 2^bucket_bits rows: the running offset is computed on a bounded frame
    offsets = hist.select(
        "_b", "_n", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_start"), F.sum("_n").over(Window.partitionBy()).alias("_total"))
    total_w = sum(q for _, q in quotas)
    uppers, upper = [], F.lit(0)
    for _, q in quotas[:-1]:
        upper = upper + F.floor(F.col("_total") * q / total_w)
        uppers.append(upper)
    inside = F.col("_nth").between(F.lit(0), F.col("_n") - 1)
    held = offsets.select("_b", "_n", "_start", F.posexplode(F.array(*uppers)).alias("_cut", "_upper")) \
        .withColumn("_nth", F.col("_upper") - F.col("_start")).where(inside).select("_b", "_cut", "_nth")  # a row per cut
    at = keyed.join(F.broadcast(held), "_b").withColumn("_pos", F.row_number().over(
        Window.partitionBy("_cut").orderBy("_h", "shipment_id")) - 1).where(F.col("_pos") == F.col("_nth"))
    return at.agg(*[F.max(F.when(F.col("_cut") == i, F.struct("_h", "shipment_id"))).alias(f"_cut{i}")
                    for i in range(len(uppers))])


def _order_hash(seed: int) -> Column:
    return md5_int(str(seed), "shipment_id", ORDER_HEX_DIGITS)


def split_of(cuts: Sequence[Column | None], seed: int = SEED, quotas=SPLIT_QUOTAS) -> Column:
    """The split of a row by its own id and the cuts of ``split_bounds`` (None: no id
    comes after that split); NULL without an id."""
    own, label = F.struct(_order_hash(seed).alias("_h"), F.col("shipment_id")), None
    for (name, _), cut in zip(quotas, cuts):
        before = F.lit(True) if cut is None else cut.isNull() | (own < cut)
        label = F.when(before, name) if label is None else label.when(before, name)
    return F.when(F.col("shipment_id").isNotNull(), F.lit(quotas[-1][0]) if label is None else label.otherwise(quotas[-1][0]))


def known_cuts(bounds: DataFrame) -> list[Column | None]:
    """The cuts of ``split_bounds`` (one row) as constants."""
    return [None if c is None else F.struct(F.lit(c["_h"]).alias("_h"), F.lit(c["shipment_id"]).alias("shipment_id"))
            for c in bounds.first()]


def split_manifest(shipments: DataFrame, seed: int = SEED, quotas=SPLIT_QUOTAS, bucket_bits: int = 16,
                   cuts: Sequence[Column | None] | None = None) -> DataFrame:
    """(shipment_id, split, split_seed), exact quotas over distinct ids; ``cuts``
    where known already."""
    ids = shipments.select("shipment_id").where(F.col("shipment_id").isNotNull()).distinct()
    if cuts is None:
        bounds = split_bounds(shipments, seed, quotas, bucket_bits)
        ids, cuts = ids.crossJoin(F.broadcast(bounds)), [F.col(c) for c in bounds.columns]  # one row
    return ids.select("shipment_id", split_of(cuts, seed, quotas).alias("split"), F.lit(seed).cast("int").alias("split_seed"))


def split_by_ratio(shipments: DataFrame, seed: int = SEED, quotas=SPLIT_QUOTAS) -> DataFrame:
    """D1 ratio mode: no ranking at all; a pure hash threshold per id."""
    u = md5_int(str(seed), "shipment_id", 8).cast("double") / F.lit(float(2 ** 32))
    total = sum(q for _, q in quotas)
    expr, acc = None, 0
    for name, q in quotas[:-1]:
        acc += q
        cond = u < F.lit(acc / total)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return shipments.select("shipment_id", expr.otherwise(quotas[-1][0]).alias("split"),
                            F.lit(seed).cast("int").alias("split_seed")).distinct()


def with_split(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Attach the split label to every row (one join, reused by all filters)."""
    return rows.join(manifest.select("shipment_id", *[c for c in manifest.columns if c.startswith("split")]),
                     "shipment_id", "left")


def group_folds(df: DataFrame, k: int, salt: str, key: str = "shipment_id",
                name: str = "fold") -> DataFrame:
    """D3: fold = pmod(md5 prefix of salt:id, k); a pure function of the id."""
    return df.withColumn(name, fold_of(key, salt, k))


def split_leak_check(manifest: DataFrame) -> DataFrame:
    """Shipments assigned to more than one split (expected: none)."""
    return (manifest.groupBy("shipment_id")
            .agg(F.countDistinct("split").alias("n_splits"))
            .where(F.col("n_splits") > 1))


def fold_overlap(fit_ids: DataFrame, held_ids: DataFrame) -> DataFrame:
    """Ids both fitted on and held out (expected: none)."""
    return fit_ids.select("shipment_id").join(held_ids.select("shipment_id"),
                                              "shipment_id", "left_semi").distinct()
