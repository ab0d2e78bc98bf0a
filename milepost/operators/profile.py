"""Profiling (EDA) tables.  Each is one aggregate; dimension frames
keep empty categories (value_counts().reindex(fill_value=0) semantics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.config import MATERIAL_DELAY_HOURS, STAGES
from milepost.operators.quantile import grouped_medians

# Delay bucket labels and edges (right-closed).
DELAY_BUCKETS = (("early_or_on_time", None, 0.0), ("1_to_6h", 0.0, 6.0),
                 ("6_to_12h", 6.0, 12.0), ("over_12h", 12.0, None))
PROPAGATION = (
    ("port_delay_to_customs_increment", "port_arrival_delay_hours", "customs_incremental_delay_hours"),
    ("customs_increment_to_inland_increment", "customs_incremental_delay_hours",
     "inland_incremental_delay_hours"),
    ("port_delay_to_final_delay", "port_arrival_delay_hours", "final_delay_hours"),
)
AVAILABILITY = ("observed_departure_delay_hours", "observed_port_arrival_delay_hours",
                "observed_customs_delay_hours", "truck_availability_score")


def _dim(spark, name: str, values) -> DataFrame:
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{name} string, _order int")


def _n() -> F.Column:
    return F.count(F.lit(1)).cast("bigint")


def snapshot_counts_by_stage(snapshots: DataFrame, stages=STAGES) -> DataFrame:
    """K1: every stage present, missing stages 0."""
    dim = F.broadcast(_dim(snapshots.sparkSession, "snapshot_stage", stages))
    agg = snapshots.groupBy("snapshot_stage").agg(_n().alias("snapshots"))
    return (dim.join(agg, "snapshot_stage", "left").orderBy("_order")
            .select("snapshot_stage", F.coalesce("snapshots", F.lit(0).cast("bigint")).alias("snapshots")))


def counts_by(shipments: DataFrame, col: str) -> DataFrame:
    """K2/K3: shipments per value, count desc (ties by value)."""
    return (shipments.groupBy(col).agg(_n().alias("shipments"))
            .orderBy(F.col("shipments").desc(), F.col(col)))


def planned_duration_by_route(shipments: DataFrame) -> DataFrame:
    """K4: median planned ocean / customs / inland hours per route."""
    return grouped_medians(shipments, ["route"], [
        "planned_ocean_hours", "planned_customs_hours", "planned_inland_hours"]).orderBy("route")


def route_delay(shipments: DataFrame, threshold: float = MATERIAL_DELAY_HOURS) -> DataFrame:
    """K5: shipments, material-delay rate, median final delay per route."""
    material = F.coalesce(F.col("final_delay_hours") > threshold, F.lit(False)).cast("double")
    counts = shipments.groupBy("route").agg(_n().alias("shipments"), F.avg(material).alias("material_delay_rate"))
    middle = grouped_medians(shipments, ["route"], ["final_delay_hours"]).select(
        F.col("route").alias("_route"), F.col("final_delay_hours").alias("median_final_delay_hours"))
    return (counts.join(middle, F.col("route").eqNullSafe(F.col("_route"))).drop("_route").orderBy("route"))


def delay_buckets(shipments: DataFrame) -> DataFrame:
    """K6: (-inf,0], (0,6], (6,12], (12,inf) with zero-filled buckets."""
    d = F.col("final_delay_hours")
    b = None
    for label, lo, hi in DELAY_BUCKETS:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (d > lo)
        if hi is not None:
            cond = cond & (d <= hi)
        b = F.when(cond, label) if b is None else b.when(cond, label)
    agg = shipments.select(b.alias("bucket")).groupBy("bucket").agg(_n().alias("shipments"))
    dim = F.broadcast(_dim(shipments.sparkSession, "bucket", [x[0] for x in DELAY_BUCKETS]))
    return (dim.join(agg, "bucket", "left").orderBy("_order")
            .select("bucket", F.coalesce("shipments", F.lit(0).cast("bigint")).alias("shipments")))


def delay_distribution(shipments: DataFrame) -> DataFrame:
    """K7: mean, median, sample standard deviation of the final delay."""
    spread = shipments.agg(F.avg("final_delay_hours").alias("mean_final_delay_hours"),
                           F.stddev_samp("final_delay_hours").alias("std_final_delay_hours"))
    middle = grouped_medians(shipments, [], ["final_delay_hours"]).withColumnRenamed(
        "final_delay_hours", "median_final_delay_hours")
    return spread.crossJoin(middle).select(  # one row each
        "mean_final_delay_hours", "median_final_delay_hours", "std_final_delay_hours")


def propagation(shipments: DataFrame) -> DataFrame:
    """K8: three Pearson correlations in one aggregate, returned long."""
    wide = shipments.agg(*[F.corr(a, b).alias(name) for name, a, b in PROPAGATION])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("relation"), F.col(name).alias("correlation"))
        for name, _, _ in PROPAGATION])))


def update_quality(events: DataFrame) -> DataFrame:
    """K9: events, missing rate, late rate per milestone."""
    return (events.groupBy("milestone").agg(
        _n().alias("events"),
        F.avg(F.col("is_update_missing").cast("double")).alias("missing_update_rate"),
        F.avg(F.col("is_late_update").cast("double")).alias("late_update_rate")).orderBy("milestone"))


def feature_availability(snapshots: DataFrame, stages=STAGES) -> DataFrame:
    """Fraction of non-NULL evidence per stage, in stage order."""
    agg = snapshots.groupBy("snapshot_stage").agg(*[
        F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in AVAILABILITY])
    dim = F.broadcast(_dim(snapshots.sparkSession, "snapshot_stage", stages))
    return dim.join(agg, "snapshot_stage", "left").orderBy("_order").select("snapshot_stage", *AVAILABILITY)


def mean_delay_by_route(shipments: DataFrame) -> DataFrame:
    """Mean final delay per route (chart data)."""
    return (shipments.groupBy("route").agg(F.avg("final_delay_hours").alias("mean_final_delay_hours"))
            .orderBy("route"))


def delay_histogram(shipments: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width bins from min to max (last bin closed); min/max come
    from one partial aggregate, binning is row-local, empty bins kept."""
    spark = shipments.sparkSession
    d = F.col("final_delay_hours")
    rng = shipments.agg(F.min(d).alias("_lo"), F.max(d).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((d - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    counted = (shipments.select("final_delay_hours").where(d.isNotNull())
               .crossJoin(F.broadcast(rng))  # one row
               .select(idx.alias("bin")).groupBy("bin").agg(_n().alias("shipments")))
    dim = spark.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(rng))
    return (dim.join(counted, "bin", "left").orderBy("bin").select(
        "bin", (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("shipments", F.lit(0).cast("bigint")).alias("shipments")))


def propagation_points(shipments: DataFrame, fraction: float | None = None, seed: int = 0) -> DataFrame:
    """Scatter points of the three propagation pairs (optional sample for
    plotting at scale; the sample is a feature of this chart-data operator)."""
    pts = shipments.select("shipment_id", "port_arrival_delay_hours",
                           "customs_incremental_delay_hours", "inland_incremental_delay_hours",
                           "final_delay_hours")
    return pts.sample(fraction=fraction, seed=seed) if fraction else pts
