"""Reporting operators (case selection, recommendations, report tables)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.config import RISK_THRESHOLD

# Recommendation texts and case titles of the original reports.
ESCALATE = "Escalate operational follow-up for the predicted material-delay risk."
DOCUMENTS = "Prioritize document completion and pre-clearance review."
REQUEST_UPDATE = "Request a verified operational update because event coverage is incomplete."
CONTINUE = "Continue monitoring the next milestone update."
NOT_APPLICABLE = "Not applicable at S1."
DOCUMENT_READINESS_FLOOR = 0.6
ETA_REPORT_METHODS = ("Direct HGB v2", "Structured HGB v2", "Stage-routed v2 policy")


def top1(df: DataFrame, *order: Column) -> DataFrame:
    """Top-1 by the given order (TakeOrdered: per-partition top-1, then merge)."""
    return df.orderBy(*order).limit(1)


def case_s1_highest_risk(pred: DataFrame, prob: str = "risk_probability") -> DataFrame:
    """L1: S1 row with the highest probability (id asc on ties)."""
    return top1(pred.where(F.col("snapshot_stage") == "ORIGIN_DEPARTED"),
                F.col(prob).desc_nulls_last(), F.col("snapshot_id").asc())


def case_s2_highest_deviation(pred: DataFrame, customs: str = "predicted_customs_deviation_hours",
                              post: str = "predicted_post_customs_deviation_hours") -> DataFrame:
    """L2: S2 row with the largest customs + post-customs deviation."""
    return top1(pred.where(F.col("snapshot_stage") == "PORT_ARRIVED")
                .withColumn("_total", F.col(customs) + F.col(post)),
                F.col("_total").desc_nulls_last(), F.col("snapshot_id").asc()).drop("_total")


def case_s3_lowest_risk(pred: DataFrame, prob: str = "risk_probability") -> DataFrame:
    """L3: S3 row with the lowest probability (id asc on ties)."""
    return top1(pred.where(F.col("snapshot_stage") == "CUSTOMS_CLEARED"),
                F.col(prob).asc_nulls_last(), F.col("snapshot_id").asc())


def recommendations(prob: str = "risk_probability", threshold: float = RISK_THRESHOLD) -> Column:
    """Rule list; a missing score switches its rule off; default when empty."""
    acts = F.array_compact(F.array(
        F.when(F.col(prob) >= threshold, F.lit(ESCALATE)),
        F.when(F.coalesce(F.col("document_readiness_score"), F.lit(1.0)) < DOCUMENT_READINESS_FLOOR,
               F.lit(DOCUMENTS)),
        F.when(F.coalesce(F.col("event_completeness_score"), F.lit(1.0)) < 1.0, F.lit(REQUEST_UPDATE)),
    ))
    return F.when(F.size(acts) == 0, F.array(F.lit(CONTINUE))).otherwise(acts)


def waterfall_text() -> Column:
    """L4 waterfall by stage."""
    s = F.col("snapshot_stage")
    return (F.when(s == "PORT_ARRIVED", F.format_string(
        "planned customs %.2fh + customs deviation %.2fh + planned post-customs %.2fh + "
        "post-customs deviation %.2fh", "planned_customs_remaining_hours",
        "predicted_customs_deviation_hours", "planned_post_customs_remaining_hours",
        "predicted_post_customs_deviation_hours"))
        .when(s == "CUSTOMS_CLEARED", F.format_string(
            "planned inland %.2fh + inland deviation %.2fh", "planned_inland_remaining_hours",
            "predicted_inland_deviation_hours"))
        .otherwise(F.lit(NOT_APPLICABLE)))


def case_rows(pred: DataFrame, threshold: float = RISK_THRESHOLD) -> DataFrame:
    """L1-L4: the three selected cases as report rows."""
    cases = (case_s1_highest_risk(pred).withColumn("case", F.lit("S1 highest risk"))
             .unionByName(case_s2_highest_deviation(pred).withColumn("case", F.lit("S2 highest structured deviation")))
             .unionByName(case_s3_lowest_risk(pred).withColumn("case", F.lit("S3 lowest risk"))))
    return cases.select(
        "case", "shipment_id", "snapshot_id", "route", "snapshot_stage", "predicted_final_eta",
        F.round("predicted_final_delay_hours", 2).alias("predicted_delay_hours"),
        F.round("risk_probability", 3).alias("risk_probability"),
        F.col("predicted_material_delay").alias("alert"),
        waterfall_text().alias("waterfall"),
        recommendations(threshold=threshold).alias("actions"),
        F.round("target_final_delay_hours", 2).alias("actual_final_delay_hours"))


def quality_counts(shipments: DataFrame, events: DataFrame, snapshots: DataFrame,
                   report: DataFrame) -> DataFrame:
    """Counts (events counted for real) and the overall verdict."""
    one = lambda df, n: df.agg(F.count(F.lit(1)).cast("bigint").alias(n))
    verdict = report.agg(F.when(F.min(F.col("passed").cast("int")) == 1, "passed")
                         .otherwise("failed").alias("verdict"))
    return (one(shipments, "shipments").crossJoin(one(events, "events"))
            .crossJoin(one(snapshots, "snapshots")).crossJoin(verdict))  # one row each


def report_metrics(comparison: DataFrame, methods=None, decimals: int = 3) -> DataFrame:
    """Metric table rounded for reports (optionally a subset of methods)."""
    df = comparison if methods is None else comparison.where(F.col("method").isin(list(methods)))
    return df.select("method", "scope", "n_snapshots",
                     F.round("mae_hours", decimals).alias("mae_hours"),
                     F.round("rmse_hours", decimals).alias("rmse_hours"))


def risk_report(risk: DataFrame, decimals: int = 3) -> DataFrame:
    """Risk rows rounded for reports."""
    return risk.select("method", "scope", F.round("pr_auc", decimals).alias("pr_auc"),
                       F.round("brier_score", decimals).alias("brier_score"),
                       F.round("f1", decimals).alias("f1"))


def risk_by_stage(pred: DataFrame, prob: str = "risk_probability") -> DataFrame:
    """Mean calibrated risk by stage."""
    return (pred.groupBy("snapshot_stage").agg(F.avg(prob).alias("mean_risk_probability"))
            .orderBy("snapshot_stage"))


def mae_by_method(comparison: DataFrame) -> DataFrame:
    """ALL-scope MAE per method."""
    return comparison.where(F.col("scope") == "ALL").select("method", "mae_hours")
