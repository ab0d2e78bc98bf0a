"""Chunks of documents that ask questions of the whole corpus.

A chunk is one row: a few MB of documents, compressed, written once to the
shared checkpoint folder and hash partitioned by its number.  The number is the
input partition and the chunk's place in it, so a task that runs again gives the
same chunks (the documents must come from a scan or a written table, whose
partitions repeat their rows in order).  In a round every
chunk sends at most one entry per key (its own repeats are merged before the
shuffle, so a key that a third of the documents share costs one entry a chunk)
to the key's bucket; the bucket sorts its entries and answers each chunk in the
order of its entries.  Texts are never shuffled again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import bounded, checkpointed, map_batches, utf8, workers_find_package

CHUNK = 2 << 20
NO_ID = np.iinfo(np.int64).max  # a null id: after all others, and smaller than none


class Chunk:
    """Ids (null: NO_ID), whether they are null, and texts as bytes."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, texts: list[bytes]):
        self.ids, self.null, self.texts = ids, null, texts

    def pack(self) -> bytes:
        n = len(self.texts)
        head = np.array([n], np.int64).tobytes() + self.ids.tobytes() + self.null.tobytes()
        size = np.array([len(t) for t in self.texts], np.int64).tobytes()
        return zstandard.ZstdCompressor(level=3).compress(head + size + b"".join(self.texts))

    @staticmethod
    def unpack(raw: bytes) -> "Chunk":
        raw = zstandard.ZstdDecompressor().decompress(raw)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        ids = np.frombuffer(raw, np.int64, n, 8)
        null = np.frombuffer(raw, bool, n, 8 + 8 * n)
        size = np.frombuffer(raw, np.int64, n, 8 + 9 * n)
        end = 8 + 17 * n + np.cumsum(size)
        return Chunk(ids, null, [raw[e - s:e] for e, s in zip(end.tolist(), size.tolist())])


def pack(docs: DataFrame, limit: int = CHUNK) -> DataFrame:
    """chunk, data: the documents (doc_id, text) in chunks, checkpointed."""
    def run(batches):
        first = TaskContext.get().partitionId() << 40
        for n, batch in enumerate(bounded(batches, limit=limit)):
            column = batch.column("doc_id")
            null = np.array(column.is_null(), bool)
            ids = np.where(null, NO_ID, column.fill_null(0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([first + n], pa.int64()),
                "data": pa.array([Chunk(ids, null, utf8(batch)).pack()], pa.binary())})

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a checkpoint keeps its partitioning only if the plan is fixed beforehand;
    # then the rounds' joins on the chunk number shuffle answers, not texts
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return checkpointed(map_batches(docs, run, "chunk long, data binary").repartition(parts, "chunk"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def buckets(packed: DataFrame, per_bucket: int, entries_per_byte: float) -> int:
    """Power of two of buckets, so that each gets about ``per_bucket`` entries."""
    n = packed.count() * CHUNK * entries_per_byte
    parts = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(int(np.ceil(np.log2(max(n / per_bucket, 2 * parts, 2)))), 1)


def cut(bucket: np.ndarray, n: int) -> list[tuple[int, slice]]:
    """(bucket, slice) for entries that are sorted by bucket."""
    at = np.searchsorted(bucket, np.arange(n + 1))
    return [(b, slice(at[b], at[b + 1])) for b in np.flatnonzero(np.diff(at)).tolist()]


def ask(packed: DataFrame, emit: Callable[[Chunk, list], Iterator[tuple[int, bytes]]],
        answer: Callable[[int, list[bytes]], list[bytes]], name: str) -> DataFrame:
    """``packed`` with a column ``name``: the answers to each chunk's entries, as
    bytes in the order of its buckets.  ``emit`` gives (bucket, entries) of a
    chunk and of the answers it already has; ``answer`` gets a bucket's number
    and the entries that all chunks sent to it."""
    have = [c for c in packed.columns if c not in ("chunk", "data")]

    def questions(batches):
        for batch in batches:
            for row in batch.to_pylist():
                sent = list(emit(Chunk.unpack(row["data"]), [joined(row[c]) for c in have]))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([b for b, _ in sent], pa.int64()),
                    "chunk": pa.array([row["chunk"]] * len(sent), pa.int64()),
                    "entries": pa.array([e for _, e in sent], pa.binary())})

    def reply(key: tuple, table: pa.Table) -> pa.Table:
        out = answer(key[0].as_py(), table.column("entries").to_pylist())
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "answer": pa.array(out, pa.binary())})

    workers_find_package(packed.sparkSession)
    sent = map_batches(packed, questions, "bucket long, chunk long, entries binary")
    got = sent.groupBy("bucket").applyInArrow(reply, "chunk long, bucket long, answer binary")
    own = checkpointed(got.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "answer")).alias(name)))
    return packed.join(own.hint("shuffle_hash"), "chunk", "left")


def joined(answers: list[dict] | None) -> bytes:
    return b"".join(x["answer"] for x in sorted(answers or [], key=lambda x: x["bucket"]))


def finish(packed: DataFrame, fn: Callable[[Chunk, list], pa.RecordBatch], schema: str) -> DataFrame:
    """Rows that ``fn`` makes of each chunk and its answers."""
    have = [c for c in packed.columns if c not in ("chunk", "data")]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield fn(Chunk.unpack(row["data"]), [joined(row[c]) for c in have])

    return map_batches(packed, run, schema)


def first_flags(_: int, entries: list[bytes]) -> list[bytes]:
    """Entries are (key, smallest id in the chunk), 16 bytes; the answer is one
    byte each: 1 where another chunk has the key with a smaller id."""
    size = [len(e) // 16 for e in entries]
    both = np.frombuffer(b"".join(entries), np.int64).reshape(-1, 2)
    order = np.lexsort((both[:, 1], both[:, 0]))
    key, low = both[order, 0], both[order, 1]
    start = np.r_[True, key[1:] != key[:-1]]
    least = low[np.maximum.accumulate(np.where(start, np.arange(len(key)), 0))]
    flag = np.zeros(len(key), np.uint8)
    flag[order] = low > least
    return split(flag, size)


def split(flat: np.ndarray, size: list[int]) -> list[bytes]:
    end = np.cumsum(size)
    return [flat[e - s:e].tobytes() for e, s in zip(end, size)]
