"""Helpers shared by the corpus operators: table access, bounded Arrow batches,
checkpoints in the cluster's shared folder and column naming."""

from __future__ import annotations

import os
from pathlib import Path
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.session import ensure_checkpoint_dir

#: Text bytes handled at once inside a task; bounds a Python worker's memory.
CHUNK_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text; other columns, whatever their names, stay out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def bounded(batches: Iterator[pa.RecordBatch], text: str = "text",
            limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` text bytes (one long
    text may exceed it alone)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(size.astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            done = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def workers_find_package(spark: SparkSession) -> None:
    """Python workers get this package's folder on their path, so that a session
    started elsewhere can unpickle its functions; where the package is installed
    on the executors this changes nothing."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """mapInArrow for functions of this package."""
    workers_find_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str,
              limit: int = CHUNK_BYTES, text: str = "text") -> DataFrame:
    """mapInArrow over bounded batches; ``fn`` returns the output columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in bounded(batches, text, limit):
            out = fn(batch)
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                 for x, f in ((out[f.name], f) for f in target)], schema=target)

    return map_batches(df, run, schema)


_KEPT: dict = {}


def kept(key: tuple, build: Callable):
    """What a Python worker keeps between tasks: one object, the last one used, so
    that operators that follow one another don't add up in its memory."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


def free_name(name: str, taken: list[str]) -> str:
    """``name``, lengthened until it clashes with no column (of any case)."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the session names (see milepost.session)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [x if x is not None else "" for x in batch.column(name).to_pylist()]


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    column = batch.column(name).cast(pa.binary())
    return [x if x is not None else b"" for x in column.to_pylist()]
