"""Operator 4: BPE encoding and decoding by batched numpy merge rounds.

The distinct new pre-tokens of a batch lie in one flat symbol array.  A round
looks every adjacent pair up by binary search over the sorted pair keys, takes
each word's lowest rank, and merges all its occurrences (left to right where
they overlap).  Words without a mergeable pair leave the array.  Encoded words
are kept in a bounded per-worker table.

Defined results: null text is empty text (no tokens, empty decoded text); every
row gives one row, repeated rows included; a null id stays null; other columns
are ignored; an empty table gives no rows.  Texts are handled whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm import bpe_tables
from milepost.llm.bpe_tables import NO_RANK, BpeTables, pre_tokens
from milepost.llm.common import bounded, free_name, id_text, kept, map_arrow, map_batches, read_table, texts

#: Distinct pre-tokens that a worker remembers before it starts afresh.
KNOWN_WORDS = 200_000


def merge_rounds(tables: BpeTables, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in one flat array, and each word's id count."""
    size = np.array([len(w) for w in words], np.int64)
    sym = tables.byte_symbol[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), size)
    done_sym, done_word = [], []
    while len(sym):
        start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        rank = np.full(len(sym), NO_RANK, np.int32)
        rank[:-1] = np.where(word[1:] == word[:-1], tables.ranks(sym[:-1], sym[1:]), NO_RANK)
        lowest = np.minimum.reduceat(rank, start)
        length = np.diff(np.r_[start, len(sym)])
        open_word = np.repeat(lowest != NO_RANK, length)
        done_sym.append(sym[~open_word])
        done_word.append(word[~open_word])
        hit = open_word & (rank == np.repeat(lowest, length))
        # overlapping occurrences (a a a): every second of a run, from its left end
        at = np.flatnonzero(hit)
        if len(at):
            run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
            step = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[step % 2 == 0]
        sym = sym.copy()
        sym[at] = tables.rank_product[rank[at]]
        keep = open_word.copy()
        keep[at + 1] = False
        sym, word = sym[keep], word[keep]
    sym, word = np.concatenate(done_sym or [sym]), np.concatenate(done_word or [word])
    order = np.argsort(word, kind="stable")
    return sym[order], np.bincount(word, minlength=len(words))


def ragged(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions at[i], at[i]+1, ... size[i] of them, for all i in a row."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(at - (end - size), size)


class WordTable:
    """Ids of the pre-tokens seen by this worker, as one flat array."""

    def __init__(self, tables: BpeTables):
        self.tables = tables
        self.special = tables.splitter()
        self.reset()

    def reset(self):
        self.index: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one flat array, and each text's id count."""
        split = [pre_tokens(t, self.special) for t in batch]
        if len(self.index) > KNOWN_WORDS:
            self.reset()
        new = list(set().union(*split) - self.index.keys())
        if new:
            plain = [w for w in new if w not in self.tables.special]
            ids, size = merge_rounds(self.tables, [w.encode() for w in plain])
            extra = [w for w in new if w in self.tables.special]
            ids = np.r_[self.ids, ids, [self.tables.special[w] for w in extra]].astype(np.int32)
            size = np.r_[self.size, size, np.ones(len(extra))].astype(np.int64)
            self.index.update(zip(plain + extra, range(len(self.index), len(size))))
            self.ids, self.size, self.at = ids, size, np.cumsum(size) - size
        count = [len(s) for s in split]
        look = self.index.__getitem__
        word = np.fromiter((look(w) for s in split for w in s), np.int64, sum(count))
        size = self.size[word]
        ids = self.ids[ragged(self.at[word], size)]
        total = np.r_[0, np.cumsum(size)]
        end = np.cumsum(count)
        return ids, total[end] - total[end - count]


def decode_ids(tables: BpeTables, ids: np.ndarray, count: np.ndarray) -> list[str]:
    """Texts of ids given flat; bytes that aren't UTF-8 become U+FFFD."""
    size = tables.token_len[ids]
    flat = tables.token_bytes[ragged(tables.token_at[ids], size)].tobytes()
    end = np.r_[0, np.cumsum(size)][np.cumsum(count)]
    return [flat[a:b].decode("utf-8", "replace") for a, b in zip(np.r_[0, end[:-1]], end)]


def _binary(flat: np.ndarray, count: np.ndarray) -> pa.Array:
    """One binary value for each text: its ids as little-endian 32-bit integers."""
    offset = np.r_[0, np.cumsum(count) * 4].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(count),
                                 [None, pa.py_buffer(offset), pa.py_buffer(flat.astype("<u4").tobytes())])


def _words(shared) -> WordTable:
    raw = shared.value
    return kept(("words", hash(raw)), lambda: WordTable(BpeTables(raw)))


def encode(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids: the ids as packed little-endian 32-bit integers."""
    shared = bpe_tables.load(docs.sparkSession, tokenizer)

    def run(batch):
        flat, count = _words(shared).encode(texts(batch))
        return {"doc_id": batch.column("doc_id"), "n_tokens": count, "ids": _binary(flat, count)}

    return map_arrow(id_text(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """doc_id, n_tokens, ids, text of packed ids; null ids decode to empty text."""
    shared = bpe_tables.load(encoded.sparkSession, tokenizer)

    def run(batch):
        raw = [x or b"" for x in batch.column("ids").to_pylist()]
        count = np.array([len(x) // 4 for x in raw], np.int64)
        ids = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
        return {"doc_id": batch.column("doc_id"), "n_tokens": count, "ids": batch.column("ids"),
                "text": decode_ids(_words(shared).tables, ids, count)}

    packed = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return map_arrow(packed, run, "doc_id long, n_tokens long, ids binary, text string", text="ids")


def round_trip(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids, text: encoded, and decoded again from the ids, in one
    pass (one Python worker per task instead of two)."""
    shared = bpe_tables.load(docs.sparkSession, tokenizer)

    def run(batch):
        words = _words(shared)
        flat, count = words.encode(texts(batch))
        return {"doc_id": batch.column("doc_id"), "n_tokens": count, "ids": _binary(flat, count),
                "text": decode_ids(words.tables, flat.astype(np.int64), count)}

    return map_arrow(id_text(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids binary, text string")


def digest(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    return round_trip(docs, tokenizer).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def with_tokens(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``docs``, all rows and columns, with n_tokens, packed ids, and the digests of the
    ids and of the text decoded from them; a new column whose name is taken gets a
    longer one."""
    from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

    shared = bpe_tables.load(docs.sparkSession, tokenizer)
    kinds = {"n_tokens": LongType(), "ids": BinaryType(), "ids_sha256": StringType(), "decoded_sha256": StringType()}
    names = {k: free_name(k, docs.columns) for k in kinds}
    text = docs.columns.index("text")

    def run(batches):
        for batch in bounded(batches):
            words = _words(shared)
            own = [x if x is not None else "" for x in batch.column(text).to_pylist()]
            flat, count = words.encode(own)
            ids = _binary(flat, count)
            decoded = decode_ids(words.tables, flat.astype(np.int64), count)
            made = {"n_tokens": pa.array(count, pa.int64()), "ids": ids,
                    "ids_sha256": pa.array([hashlib.sha256(x.as_py()).hexdigest() for x in ids], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string())}
            for k, column in made.items():
                batch = batch.append_column(names[k], column)
            yield batch

    return map_batches(docs, run, StructType([*docs.schema.fields, *[StructField(names[k], t) for k, t in kinds.items()]]))


def query(spark, sf_dir: str) -> DataFrame:
    return digest(read_table(spark, sf_dir, "documents"))
