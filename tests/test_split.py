"""Exact quotas, no leakage, partition invariance."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from milepost.functions.expr import md5_int
from milepost.operators import split as S


def test_exact_quotas_and_no_leak(small):
    n = small.shipments.count()
    sizes = {r.split: r["count"] for r in small.manifest.groupBy("split").count().collect()}
    expect = dict(S.quota_counts(n))
    assert sizes == expect and sum(sizes.values()) == n
    assert S.split_leak_check(small.manifest).count() == 0


def test_quota_counts_of_original_population():
    assert S.quota_counts(250) == [("train", 175), ("validation", 37), ("test", 38)]


def test_bucketed_rank_equals_global_rank(small):
    ids = small.shipments.select("shipment_id")
    h = md5_int("20260715", "shipment_id", 15)
    glob = (ids.select("shipment_id", h.alias("h"))
            .withColumn("pos", F.row_number().over(Window.orderBy("h", "shipment_id")) - 1))
    n = ids.count()
    cut1, cut2 = n * 175 // 250, n * 175 // 250 + n * 37 // 250
    expected = glob.select("shipment_id", F.when(F.col("pos") < cut1, "train")
                           .when(F.col("pos") < cut2, "validation").otherwise("test").alias("split"))
    got = S.split_manifest(ids, bucket_bits=4).select("shipment_id", "split")
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_manifest_is_partition_invariant(small):
    a = S.split_manifest(small.shipments.repartition(7))
    b = S.split_manifest(small.shipments.coalesce(1))
    assert a.exceptAll(b).count() == 0


def test_folds_balanced_and_nested_salts_independent(small):
    ids = small.shipments.select("shipment_id")
    f0 = S.group_folds(ids, 5, "20260715")
    counts = [r["count"] for r in f0.groupBy("fold").count().collect()]
    assert len(counts) == 5 and min(counts) > 0.15 * sum(counts)
    # inner folds of one outer complement must not be empty with a level salt
    inner = S.group_folds(f0.where("fold != 0"), 5, "20260715/1", name="inner")
    assert inner.select("inner").distinct().count() == 5


def test_ratio_split_is_deterministic(small):
    a = S.split_by_ratio(small.shipments)
    assert a.exceptAll(S.split_by_ratio(small.shipments.repartition(3))).count() == 0


def test_rows_know_their_split_by_the_cuts(spark):
    """Equal to the manifest's, also for ids that repeat or are missing and for empty splits."""
    for n in (0, 1, 2, 3, 250):
        ids = spark.createDataFrame([(str(i),) for i in range(n)] * 2 + [(None,)], "shipment_id string")
        cuts = S.known_cuts(S.split_bounds(ids, bucket_bits=4))
        got = ids.select("shipment_id", S.split_of(cuts).alias("split"))
        assert [r.split for r in got.where("shipment_id IS NULL").collect()] == [None]
        known = got.where("shipment_id IS NOT NULL").distinct()
        assert known.exceptAll(S.split_manifest(ids).select("shipment_id", "split")).count() == 0
        sizes = {r.split: r["count"] for r in known.groupBy("split").count().collect()}
        assert sizes == {k: v for k, v in S.quota_counts(n) if v}
