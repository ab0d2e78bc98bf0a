"""Baseline delay predictors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.functions.expr import latest_observed
from milepost.operators.encode import route_median


def scheduled(rows: DataFrame, out: str = "b0_predicted_delay_hours") -> DataFrame:
    """The schedule holds: predicted delay 0."""
    return rows.withColumn(out, F.lit(0.0))


def route_median_baseline(fit_shipments: DataFrame, rows: DataFrame,
                          out: str = "b1_predicted_delay_hours") -> DataFrame:
    """G1: fit-shipment median final delay per route, overall median fallback."""
    return route_median(fit_shipments, rows, out)


def carry_forward(rows: DataFrame, out: str = "b2_predicted_delay_hours") -> DataFrame:
    """Latest observed delay carried forward (NULL when not observed)."""
    return rows.withColumn(out, latest_observed())


def all_baselines(fit_shipments: DataFrame, rows: DataFrame) -> DataFrame:
    return carry_forward(route_median_baseline(fit_shipments, scheduled(rows)))
