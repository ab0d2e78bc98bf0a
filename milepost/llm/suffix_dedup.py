"""Operator 9: exact substring removal by distributed prefix doubling.

Byte positions get ranks by prefixes of growing length: 24 bytes, then the pair
of ranks at distance 13 (37 bytes), then the pair of those (50 bytes).  In each
round Spark brings equal ranks of all chunks together, sorts them, and answers
which are shared; positions whose rank is unique leave.

The first round ranks a sample of positions that no repeat can miss: of the 27
prefixes of 24 bytes inside a 50-byte window the one with the smallest hash.  A
run of windows with one such anchor stands or falls together as long as all
copies of the anchor lie in equal runs, so runs are ranked as wholes and only
windows of anchors with differing runs, of which a 37-byte prefix around the
anchor is shared, reach the last round.  Ranks are 64-bit hashes.  The first round
sends them shortened: of an anchor 39 bits beside its bucket's, which only makes
more candidates; of a run 48 bits, so that an anchor whose differing runs all agree
in 48 bits (chance 2**-48 for two) is taken for one whose runs are equal, and what
these runs share but for their ends stays.

Windows are judged on the input: one is removed if its smallest document is
smaller than its own, and a byte goes if any removed window covers it.

Defined results: null is empty; every row gives one row; rows with equal ids
remove nothing from each other; null ids come after all ids and remove nothing
from each other; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm import chunks
from milepost.llm.anchors import (
    FLAG, LOW39, SEGMENT, first_keys, least_ids, low_bytes, pair_rank, runs, send, shared_anchors,
    shared_keys, shared_only, stretches)
from milepost.llm.chunks import Chunk
from milepost.llm.common import id_text, read_table
from milepost.llm.wordhash import mix

LENGTH = 50
GRAM = 24
STEP = (LENGTH - GRAM) // 2
RUN_BYTES = 6
_SYMBOL = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Ranks:
    """Ranks of all positions of a piece of text, by prefix length."""

    def __init__(self, piece: np.ndarray):
        r = _SYMBOL[piece]
        for n, salt in ((1, 1), (2, 2), (4, 3), (8, 4)):
            r = pair_rank(r[:-n], r[n:], salt)
            if n == 4:
                eight = r
        self.gram = pair_rank(r[:-8], eight[16:], 5)  # 16 and 8 bytes

    def longer(self):
        """37 and 50 bytes: pairs of ranks at distance STEP."""
        self.mid = pair_rank(self.gram[:-STEP], self.gram[STEP:], 6)
        self.full = pair_rank(self.mid[:-STEP], self.mid[STEP:], 7)
        return self


class Anchors:
    """The anchors of a chunk: document, first and last window, and ranks of the
    anchor (h), of its run (run), of the 37 bytes that end and begin with it."""

    def __init__(self, chunk: Chunk, longer: bool = True):
        cols: dict[str, list] = {k: [] for k in ("doc", "first", "last", "at", "h", "run", "left", "right")}
        for d, text in enumerate(chunk.texts):
            raw = np.frombuffer(text, np.uint8)
            for lo in range(0, len(raw) - LENGTH + 1, SEGMENT):
                piece = raw[lo:lo + SEGMENT + LENGTH - 1]
                r = Ranks(piece).longer()
                p, q, a = runs(r.gram, LENGTH - GRAM + 1)
                out = [np.full(len(p), d), p + lo, q + lo, a + lo, r.gram[a],
                       pair_rank(r.full[p], r.full[q], 8) + (q - p).astype(np.uint64),
                       r.mid[np.maximum(a - STEP, 0)], r.mid[np.minimum(a, len(r.mid) - 1)]]
                for k, v in zip(cols, out):
                    cols[k].append(v)
        for k, v in cols.items():
            kind = np.int64 if k in ("doc", "first", "last", "at") else np.uint64
            setattr(self, k, np.concatenate(v).astype(kind, copy=False) if v else np.zeros(0, kind))


class Rounds:
    """The questions of the three rounds, and what the answers mean, for one chunk."""

    def __init__(self, n_buckets: int):
        self.n = n_buckets

    # round 1: anchors
    def ask_anchors(self, chunk: Chunk, _):
        a = Anchors(chunk)
        key, shared, run, _ = first_keys(a, chunk, RUN_BYTES)
        return send(key, self.n, low_bytes((key & LOW39) | np.where(shared, FLAG, np.uint64(0))), run)

    def state(self, chunk: Chunk, answers: list):
        a = Anchors(chunk)
        _, _, _, inverse = first_keys(a, chunk, RUN_BYTES)
        return a, np.frombuffer(answers[0], np.uint8)[inverse]

    # round 2: whole runs of shared anchors (buckets below n), and 37 bytes around
    # those with several runs (buckets from n on)
    def ask_runs(self, chunk: Chunk, answers: list):
        a, state = self.state(chunk, answers)
        some = state > 0
        key, low, _ = least_ids(a.run[some], chunk.ids[a.doc[some]])
        yield from send(key, self.n, key, low)
        key, shared, _ = self._around(chunk, a, state == 2)
        entries = low_bytes((key & LOW39) | np.where(shared, FLAG, np.uint64(0)))
        yield from ((self.n + b, e) for b, e in send(key, self.n, entries))

    def answer_runs(self, bucket: int, entries: list[bytes]) -> list[bytes]:
        return chunks.first_flags(bucket, entries) if bucket < self.n else shared_only(entries)

    def _around(self, chunk: Chunk, a: Anchors, several: np.ndarray):
        both = np.r_[a.left[several], a.right[several]]
        return shared_keys(both, np.tile(chunk.ids[a.doc[several]], 2))

    # round 3: windows
    def after_runs(self, chunk: Chunk, answers: list):
        """Anchors, runs to remove whole, and the windows (document, start, rank)
        that the last round decides."""
        a, state = self.state(chunk, answers)
        some = state > 0
        _, low, inverse = least_ids(a.run[some], chunk.ids[a.doc[some]])
        reply = np.frombuffer(answers[1], np.uint8)
        smaller = reply[:len(low)][inverse] > 0
        whole = np.zeros(len(a.h), bool)
        whole[some] = smaller | (chunk.ids[a.doc[some]] > low[inverse])
        several = state == 2
        near = reply[len(low):][self._around(chunk, a, several)[2]].astype(bool)
        left, right = np.zeros(len(a.h), bool), np.zeros(len(a.h), bool)
        left[several], right[several] = near[:several.sum()], near[several.sum():]
        open_run = np.flatnonzero(several & ~whole & (left | right))
        n = a.last[open_run] - a.first[open_run] + 1
        run = np.repeat(open_run, n)
        start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + a.first[run]
        keep = (left[run] & (start <= a.at[run] - STEP)) | (right[run] & (start + LENGTH >= a.at[run] + GRAM + STEP))
        run, start = run[keep], start[keep]
        doc = a.doc[run]
        rank = np.zeros(len(start), np.uint64)
        for d, lo, hi in stretches(doc):
            rank[lo:hi] = _window_ranks(chunk.texts[d], start[lo:hi])
        return a, whole, doc, start, rank

    def ask_windows(self, chunk: Chunk, answers: list):
        _, _, doc, _, rank = self.after_runs(chunk, answers)
        key, low, _ = least_ids(rank, chunk.ids[doc])
        return send(key, self.n, key, low)

    def removed(self, chunk: Chunk, answers: list) -> list[np.ndarray]:
        """For each document, whether each byte is removed."""
        a, whole, doc, start, rank = self.after_runs(chunk, answers)
        _, low, inverse = least_ids(rank, chunk.ids[doc])
        gone = (np.frombuffer(answers[2], np.uint8)[inverse] > 0) | (chunk.ids[doc] > low[inverse])
        first = np.r_[a.first[whole], start[gone]]
        last = np.r_[a.last[whole], start[gone]] + LENGTH
        owner = np.r_[a.doc[whole], doc[gone]]
        order = np.argsort(owner, kind="stable")
        first, last, owner = first[order], last[order], owner[order]
        out = [np.zeros(len(t), bool) for t in chunk.texts]
        for d, lo, hi in stretches(owner):
            edge = np.zeros(len(out[d]) + 1, np.int32)
            np.add.at(edge, first[lo:hi], 1)
            np.add.at(edge, last[lo:hi], -1)
            out[d] = np.cumsum(edge[:-1]) > 0
        return out


def _window_ranks(text: bytes, start: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    out = np.zeros(len(start), np.uint64)
    for lo in range(0, len(raw) - LENGTH + 1, SEGMENT):
        here = (start >= lo) & (start < lo + SEGMENT)
        if here.any():
            out[here] = Ranks(raw[lo:lo + SEGMENT + LENGTH - 1]).longer().full[start[here] - lo]
    return out


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 chunk_bytes: int = chunks.CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    packed = chunks.pack(id_text(docs, id_col, text_col), chunk_bytes)
    rounds = Rounds(chunks.buckets(packed, 1 << 20, 1 / 14))
    asked = chunks.ask(packed, rounds.ask_anchors, lambda _, entries: shared_anchors(entries, RUN_BYTES), "anchors")
    asked = chunks.ask(asked, rounds.ask_runs, rounds.answer_runs, "runs")
    asked = chunks.ask(asked, rounds.ask_windows, chunks.first_flags, "windows")

    def rows(chunk: Chunk, answers: list) -> pa.RecordBatch:
        gone = rounds.removed(chunk, answers)
        kept = [np.frombuffer(t, np.uint8)[~g].tobytes() for t, g in zip(chunk.texts, gone)]
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(chunk.ids, pa.int64(), mask=chunk.null),
            "n_bytes": pa.array([len(t) for t in chunk.texts], pa.int64()),
            "n_removed": pa.array([int(g.sum()) for g in gone], pa.int64()),
            "n_spans": pa.array([int((np.diff(g.astype(np.int8), prepend=0) == 1).sum()) for g in gone], pa.int64()),
            "kept": pa.array(kept, pa.binary())})

    return chunks.finish(asked, rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def query(spark, sf_dir: str) -> DataFrame:
    out = deduplicated(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
