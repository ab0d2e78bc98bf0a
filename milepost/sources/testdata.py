"""A1 (test mapping): journeys derived deterministically from the TPC-H-like tables.

A journey is an *order*: ``orders ⋈ (lineitem grouped by l_orderkey) ⋈ customer
⋈ nation ⋈ region``.  Leg delays, scores and update delays are integer-second
expressions of the order key and the line aggregates, so any engine reproduces
them exactly.

Plan at scale: lineitem is pruned to four columns and partially aggregated
map-side before its shuffle on l_orderkey; the aggregate is already hash
partitioned on the join key, so the join with orders shuffles orders only.
customer joins by shuffle as well (both sides grow with the data); nation
(25 rows) and region (5 rows) are fixed-size dimensions and are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.config import MILESTONES

TABLES = ("region", "nation", "customer", "orders", "lineitem")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def expected_journeys(spark: SparkSession, sf_dir: str) -> int:
    """How many journeys the mapping must give: the orders that have lines, counted
    on the order keys alone."""
    lines = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return read_table(spark, sf_dir, "orders").select("o_orderkey").distinct() \
        .join(lines, "o_orderkey", "left_semi").count()


def journey_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per journey with planned durations, leg delays (seconds) and the
    five milestone update delays (seconds, NULL = update missing)."""
    t = {n: read_table(spark, sf_dir, n) for n in TABLES}
    lines = (t["lineitem"]
             .groupBy("l_orderkey")
             .agg(F.max("l_quantity").cast("bigint").alias("mq"),
                  F.min("l_quantity").cast("bigint").alias("nq"),
                  F.round(F.max("l_discount") * 100).cast("bigint").alias("md"),
                  F.round(F.max("l_tax") * 100).cast("bigint").alias("mt"),
                  F.count(F.lit(1)).cast("bigint").alias("nl")))
    geo = (t["nation"].join(F.broadcast(t["region"]),
                            F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_regionkey", "r_name"))
    cust = (t["customer"].select("c_custkey", "c_nationkey", "c_name", "c_mktsegment")
            .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")))
    # orders, their line aggregate and customers all grow with the data: shuffle
    # (sort-merge) joins, never a broadcast of a fact-sized side
    j = (t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
         .join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
         .join(cust.hint("merge"), F.col("o_custkey") == F.col("c_custkey")))
    k = F.col("o_orderkey").cast("bigint")
    rk = F.col("r_regionkey").cast("bigint")

    def score(a: int, b: int):
        return ((k * a + b) % 100).cast("double") / F.lit(100.0)

    def update_delay(idx: int):
        missing = (k * 31 + idx * 17) % 20 == 0
        base = k * 101 + idx * 7
        late = (k * 11 + idx * 13) % 7 == 0
        delay = F.when(late, F.lit(14460) + base % 200000).otherwise(F.lit(180) + base % 10000)
        return F.when(missing, F.lit(None).cast("bigint")).otherwise(delay.cast("bigint"))

    return j.select(
        k.cast("string").alias("shipment_id"),
        F.col("r_name").alias("route"),
        F.col("n_name").alias("origin"),
        F.col("r_name").alias("destination_port"),
        F.col("c_name").alias("final_destination"),
        F.col("o_orderpriority").alias("carrier"),
        F.col("c_mktsegment").alias("cargo_type"),
        score(37, 11).alias("weather_severity"),
        score(53, 29).alias("congestion_score"),
        score(71, 5).alias("document_readiness_score"),
        score(89, 43).alias("truck_availability_score"),
        F.col("o_orderdate").alias("scheduled_departure_at"),
        (240 + 24 * rk).cast("double").alias("planned_ocean_hours"),
        (32 + 2 * rk).cast("double").alias("planned_customs_hours"),
        (27 + rk).cast("double").alias("planned_inland_hours"),
        F.lit(3.0).alias("dispatch_buffer_hours"),
        (F.col("md") * 3600 - 3 * 3600).alias("departure_delay_s"),
        (F.col("mq") * 720 - 7 * 3600 + rk * 3600).alias("ocean_increment_s"),
        (F.col("mt") * 2700 + F.col("nq") * 600 - 4 * 3600).alias("customs_increment_s"),
        (F.col("nl") * 900 - 3600).alias("dispatch_increment_s"),
        (F.col("nq") * 900 - 2 * 3600).alias("final_increment_s"),
        F.array(*[update_delay(i) for i in range(len(MILESTONES))]).alias("update_delay_s"),
    )
