"""Operator 8: token counts by rank-synchronous array merging.

Batched pre-tokens are ragged numpy arrays (values and offsets).  In each step
every sequence applies its own lowest-rank pair at the same time; ranks are
kept beside the symbols and only those next to a merge are looked up again.
What survives of a sequence is its token count; no ids are kept.

Defined results: null text is empty text (0 bytes, 0 tokens); every row gives
one row, repeated rows included; a null id stays null; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm import bpe_tables
from milepost.llm.bpe_tables import NO_RANK, BpeTables, pre_tokens
from milepost.llm.common import id_text, kept, map_arrow, read_table, texts

TOKEN_LIMIT = 1024
#: Distinct pre-tokens that a worker remembers before it starts afresh.
KNOWN_WORDS = 400_000


def surviving_symbols(tables: BpeTables, words: list[bytes]) -> np.ndarray:
    """Number of symbols left of each word after all merges."""
    length = np.array([len(w) for w in words], np.int64)
    count = length.copy()
    live = np.flatnonzero(length > 1)
    value = tables.byte_symbol[np.frombuffer(b"".join([words[i] for i in live]), np.uint8)]
    length = length[live]
    end = np.cumsum(length)
    rank = np.full(len(value), NO_RANK, np.int32)
    rank[:-1] = tables.ranks(value[:-1], value[1:]) if len(value) else 0
    rank[end - 1] = NO_RANK
    while len(live):
        lowest = np.minimum.reduceat(rank, end - length)
        active = lowest != NO_RANK
        count[live[~active]] = length[~active]
        if not active.all():
            stay = np.repeat(active, length)
            value, rank = value[stay], rank[stay]
            live, length, lowest = live[active], length[active], lowest[active]
            end = np.cumsum(length)
            if not len(live):
                break
        chosen = np.flatnonzero(rank == np.repeat(lowest, length))
        # a pair may overlap itself: take every second of neighbouring places
        first = np.r_[True, chosen[1:] != chosen[:-1] + 1]
        group = np.maximum.accumulate(np.where(first, np.arange(len(chosen)), 0))
        chosen = chosen[(np.arange(len(chosen)) - group) % 2 == 0]
        value[chosen] = tables.rank_product[rank[chosen]]
        rank[chosen] = rank[chosen + 1]  # end of a sequence stays an end
        last = np.zeros(len(value), bool)
        last[end - 1] = True
        last[chosen] |= last[chosen + 1]
        gone = np.zeros(len(value), bool)
        gone[chosen + 1] = True
        place = np.cumsum(~gone) - 1
        value, rank, last = value[~gone], rank[~gone], last[~gone]
        merged = place[chosen]
        near = np.unique(np.r_[merged, np.maximum(merged - 1, 0)])
        near = near[~last[near]]
        rank[near] = tables.ranks(value[near], value[near + 1])
        rank[last] = NO_RANK
        end = np.flatnonzero(last) + 1
        length = np.diff(np.r_[0, end])
    return count


class CountTable:
    def __init__(self, tables: BpeTables):
        self.tables, self.special, self.known = tables, tables.splitter(), {}

    def count(self, batch: list[str]) -> np.ndarray:
        split = [pre_tokens(t, self.special) for t in batch]
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        new = list(set().union(*split) - self.known.keys())
        sizes = surviving_symbols(self.tables, [w.encode() for w in new]) if new else []
        self.known.update(zip(new, map(int, sizes)))
        self.known.update(dict.fromkeys(self.tables.special, 1))
        look = self.known.__getitem__
        return np.array([sum(map(look, s)) for s in split], np.int64)


def _counter(shared) -> CountTable:
    raw = shared.value
    return kept(("counts", hash(raw)), lambda: CountTable(BpeTables(raw)))


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = TOKEN_LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    shared = bpe_tables.load(docs.sparkSession, tokenizer)

    def run(batch):
        own = texts(batch)
        return {"doc_id": batch.column("doc_id"),
                "n_bytes": np.array([len(t.encode()) for t in own], np.int64),
                "n_tokens": _counter(shared).count(own)}

    counted = map_arrow(id_text(docs, id_col, text_col), run,
                        "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


def query(spark, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))
