"""A1: read journey tables with explicit schemas (parquet or headered CSV).

ISO-8601 'Z' instants in CSV are parsed with the session in UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.sources.schemas import SCHEMAS

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def read_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    schema = SCHEMAS[table]
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return _nan_is_null(reader.option("header", True).option("timestampFormat", ISO_FORMAT)
                            .option("mode", "PERMISSIVE").csv(path))
    return _nan_is_null(reader.format(fmt).load(path))


def _nan_is_null(df: DataFrame) -> DataFrame:
    """Files written by dataframe libraries hold NaN for missing numbers."""
    numbers = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numbers}) if numbers else df


def read_journey_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> dict:
    """{shipments, events, snapshots} under ``root/<table>``."""
    return {t: read_table(spark, f"{root.rstrip('/')}/{t}", t, fmt)
            for t in ("shipments", "events", "snapshots")}
