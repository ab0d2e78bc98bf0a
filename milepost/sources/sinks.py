"""Sinks.  Every write is ``mode("overwrite")`` on the job's own output
paths only (the clean boundary); nothing else under the root is touched."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from milepost.plans.layout import Layout

# The columns of the published risk predictions.
RISK_PREDICTION_COLUMNS = ("shipment_id", "snapshot_id", "snapshot_stage", "risk_raw_probability",
                           "risk_probability", "risk_level", "predicted_material_delay",
                           "target_is_materially_delayed")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None,
                small: bool = False) -> str:
    """Large tables keep their partitioning (optionally partitioned by a column);
    small metric tables are coalesced to a single file."""
    out = df.coalesce(1) if small else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_base_tables(layout: Layout, shipments: DataFrame, events: DataFrame, snapshots: DataFrame,
                      manifest: DataFrame, fmt: str = "parquet") -> dict:
    """A2: base tables (snapshots partitioned by stage) and the split manifest."""
    return {
        "shipments": write_table(shipments, layout.data("shipments"), fmt),
        "events": write_table(events, layout.data("events"), fmt),
        "snapshots": write_table(snapshots, layout.data("snapshots"), fmt, ["snapshot_stage"]),
        "split_manifest": write_table(manifest, layout.path("split", "split_manifest"), fmt),
    }


def write_risk_predictions(pred: DataFrame, path: str, fmt: str = "parquet") -> str:
    """A3: the 8-column risk projection."""
    return write_table(pred.select(*RISK_PREDICTION_COLUMNS), path, fmt)


def write_summary(spark: SparkSession, summary: dict, path: str) -> str:
    """A4: one-record JSON summary (a one-row DataFrame written as JSON)."""
    spark.createDataFrame([(json.dumps(summary, sort_keys=True),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(path)
    return path


def save_model(model, path: str) -> str:
    """A5: Spark ML persistence."""
    model.write().overwrite().save(path)
    return path


def save_fitted(spark: SparkSession, fitted, path: str) -> str:
    """A5: a model with its preprocessor, in one folder."""
    save_model(fitted.model, f"{path}/model")
    spark.createDataFrame([(fitted.prep.to_json(),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/preprocessor")
    return path


def load_fitted(spark: SparkSession, path: str, fitted: type, model: type):
    """What ``save_fitted`` wrote, as ``fitted(prep, model)``: it scores new rows."""
    from milepost.operators.features import Preprocessor
    text = spark.read.text(f"{path}/preprocessor").first().value
    return fitted(Preprocessor.from_json(text), model.load(f"{path}/model"))
