"""Operator 2: substring dedup with a compressed FM-index per shard.

A window is 50 consecutive words; it is removed if its word sequence also starts
in a document with a smaller id.  Equal windows have equal anchors (of the
8-word sequences inside, the one with the smallest hash), so shards are cut by
anchor: a window needs one shard only, and a shard holds the stretches around
anchors that at least two documents share (a first round finds these).

Each shard indexes its stretches (Burrows-Wheeler transform in a wavelet matrix)
and streams them against the index: backward search gives, for a stretch, the
maximal matches with text of smaller documents, and those of 50 words or more
are reported.  All windows of a stretch contain its middle, so a stretch whose
middle has no smaller occurrence is settled at once; else the right end of each
maximal match is found by bisection and its left end by one search.

Skew: a chunk sends equal stretches once, with their smallest id; an anchor with
very many differing stretches (each chunk tells how many it has) is cut into
single windows, which go to shards by their own hash, so that no shard gets all
stretches around a phrase that a third of all documents hold.

Defined results: null has no words; every row gives one row; rows with equal ids
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
    FLAG, LOW39, SEGMENT, bucket_of, first_keys, from_low_bytes, low_bytes, pair_rank, runs, runs_per_key, send,
    shared_anchors, stretches)
from milepost.llm.chunks import Chunk
from milepost.llm.common import id_text, read_table
from milepost.llm.fm_index import FmIndex
from milepost.llm.wordhash import span_hashes, spans

LENGTH = 50
GRAM = 8
#: Bytes of a stretch's hash by which an anchor's stretches are told apart.
RUN_BYTES = 8
#: Bytes of a word's hash that an index compares.
SYMBOL_BYTES = 6
#: Chunks from which an anchor with differing stretches is cut into windows.
HOT_CHUNKS = 2000
#: Differing stretches from which an anchor is cut, whatever the number of chunks.
HOT_STRETCHES = 2000
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


class Stretches:
    """Anchors of a chunk: document, first and last window, rank of the anchor (h)
    and of the stretch (run); and the word hashes of the documents."""

    def __init__(self, chunk: Chunk):
        cols: dict[str, list] = {k: [] for k in ("doc", "first", "last", "h", "run")}
        self.words, self.window = [], []
        for d, text in enumerate(chunk.texts):
            raw = np.frombuffer(text, np.uint8)
            word = span_hashes(raw, *spans(~_BLANK[raw]))
            self.words.append(word)
            self.window.append(np.zeros(max(len(word) - LENGTH + 1, 0), np.uint64))
            for lo in range(0, len(word) - LENGTH + 1, SEGMENT):
                r = word[lo:lo + SEGMENT + LENGTH - 1]
                for n, salt in ((1, 1), (2, 2), (4, 3), (8, 4), (16, 5)):
                    r = pair_rank(r[:-n], r[n:], salt)
                    if n == 4:
                        gram = r
                rest = LENGTH - 32
                full = pair_rank(r[:-rest], r[rest:], 6)
                self.window[d][lo:lo + len(full)] = full
                p, q, a = runs(gram, LENGTH - GRAM + 1)
                out = [np.full(len(p), d), p + lo, q + lo, gram[a],
                       pair_rank(full[p], full[q], 7) + (q - p).astype(np.uint64)]
                for k, v in zip(cols, out):
                    cols[k].append(v)
        for k, v in cols.items():
            kind = np.int64 if k in ("doc", "first", "last") else np.uint64
            setattr(self, k, np.concatenate(v).astype(kind, copy=False) if v else np.zeros(0, kind))


def _pack(key, low, size, words) -> bytes:
    return b"".join((np.array([len(key)], np.int64).tobytes(), key.tobytes(), low.tobytes(),
                     size.astype(np.int64).tobytes(), low_bytes(words, SYMBOL_BYTES).tobytes()))


def _unpack(raw: bytes):
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    key, low, size = (np.frombuffer(raw, t, n, 8 + 8 * n * i) for i, t in enumerate((np.uint64, np.int64, np.int64)))
    words = np.frombuffer(raw, np.uint8, -1, 8 + 24 * n).reshape(-1, SYMBOL_BYTES)
    return key, low, size, from_low_bytes(words)


def search(entries: list[bytes]) -> list[bytes]:
    """A shard: per entry one byte (an equal stretch has a smaller id in another
    chunk) and eight bytes (bit i: window i occurs in a document that is smaller
    than all with this stretch)."""
    parts = [_unpack(e) for e in entries]
    key, low, size = (np.concatenate([p[i] for p in parts]) for i in range(3))
    words = np.concatenate([p[3] for p in parts])
    _, pick, inverse = np.unique(key, return_index=True, return_inverse=True)
    least = np.full(len(pick), chunks.NO_ID)
    np.minimum.at(least, inverse, low)
    at = np.cumsum(size) - size
    n = size[pick]
    flat = words[np.repeat(at[pick] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    mask = matched_windows(FmIndex(flat, n, least, 2 * LENGTH), n, least)
    out = np.empty((len(key), 9), np.uint8)
    out[:, 0] = low > least[inverse]
    out[:, 1:] = mask[inverse].astype("<u8").reshape(-1, 1).view(np.uint8)
    return chunks.split(out, [len(p[0]) for p in parts])


def matched_windows(index: FmIndex, n: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For each stretch of n words a mask of the windows that a lighter one holds."""
    below = np.searchsorted(index.weights, weight)
    mask = np.zeros(len(n), np.uint64)

    def holds(text, left, end):
        return index.reach(text, end, left, below[text]) == left

    text = np.arange(len(n))
    left, most = n - LENGTH, n.copy()  # all open windows contain [left, LENGTH) and end at most there
    while len(text):
        fine = holds(text, left, np.full(len(text), LENGTH))
        text, left, most = text[fine], left[fine], most[fine]
        end = np.full(len(text), LENGTH)
        while (todo := np.flatnonzero(end < most)).size:  # the longest match that begins at left
            middle = (end[todo] + most[todo] + 1) // 2
            good = holds(text[todo], left[todo], middle)
            end[todo[good]] = middle[good]
            most[todo[~good]] = middle[~good] - 1
        start = index.reach(text, end, np.zeros(len(text), np.int64), below[text])
        count = np.maximum(end - start - LENGTH + 1, 0).astype(np.uint64)
        mask[text] |= ((np.uint64(1) << count) - np.uint64(1)) << start.astype(np.uint64)
        more = (start > 0) & (end > LENGTH)
        text, left, most = text[more], start[more] - 1, end[more] - 1
    return mask


class Rounds:
    def __init__(self, n_buckets: int, n_shards: int, hot_chunks: int, hot_stretches: int = HOT_STRETCHES):
        self.n, self.shards, self.hot, self.hot_stretches = n_buckets, n_shards, hot_chunks, hot_stretches

    def ask_anchors(self, chunk: Chunk, _):
        s = Stretches(chunk)
        key, shared, run, inverse = first_keys(s, chunk, RUN_BYTES)
        return send(key, self.n, low_bytes((key & LOW39) | np.where(shared, FLAG, np.uint64(0))), run,
                    runs_per_key(inverse, s.run))

    def answer_anchors(self, bucket: int, entries: list[bytes]) -> list[bytes]:
        return shared_anchors(entries, RUN_BYTES, self.hot, self.hot_stretches)

    def sent(self, chunk: Chunk, answers: list):
        """Stretches of shared anchors, hot ones as single windows: document, first
        and last window; and the distinct ones: shard, key, smallest id, a row."""
        s = Stretches(chunk)
        state = np.frombuffer(answers[0], np.uint8)[first_keys(s, chunk, RUN_BYTES)[3]]
        whole, hot = np.flatnonzero((state == 1) | (state == 2)), np.flatnonzero(state == 3)
        count = s.last[hot] - s.first[hot] + 1
        own = np.repeat(hot, count)
        window = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + s.first[own]
        rank = np.array([s.window[d][w] for d, w in zip(s.doc[own], window)], np.uint64)
        doc = np.r_[s.doc[whole], s.doc[own]]
        first, last = np.r_[s.first[whole], window], np.r_[s.last[whole], window]
        key, route = np.r_[s.run[whole], rank], np.r_[s.h[whole], rank]
        shard = bucket_of(route, self.shards)
        order = np.lexsort((chunk.ids[doc], key, shard))
        fresh = np.r_[True, (key[order][1:] != key[order][:-1]) | (shard[order][1:] != shard[order][:-1])][:len(order)]
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(fresh) - 1
        pick = order[fresh]
        return s, doc, first, last, inverse, pick, shard[pick], key[pick], chunk.ids[doc[pick]]

    def ask_stretches(self, chunk: Chunk, answers: list):
        s, doc, first, last, _, pick, shard, key, low = self.sent(chunk, answers)
        size = last[pick] - first[pick] + LENGTH
        for b, part in chunks.cut(shard, self.shards):
            some = pick[part]
            words = [s.words[d][a:z] for d, a, z in zip(doc[some], first[some], last[some] + LENGTH)]
            yield b, _pack(key[part], low[part], size[part], np.concatenate(words))

    def removed(self, chunk: Chunk, answers: list) -> list[np.ndarray]:
        """For each document, whether each word is removed."""
        s, doc, first, last, inverse, _, _, _, low = self.sent(chunk, answers)
        reply = np.frombuffer(answers[1], np.uint8).reshape(-1, 9)
        mask = np.ascontiguousarray(reply[:, 1:]).reshape(-1).view("<u8")[inverse]
        whole = (reply[inverse, 0] > 0) | (chunk.ids[doc] > low[inverse])
        n = last - first + 1
        row = np.repeat(np.arange(len(n)), n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        gone = whole[row] | ((mask[row] >> nth.astype(np.uint64) & np.uint64(1)) > 0)
        start, owner = (first[row] + nth)[gone], doc[row][gone]
        order = np.argsort(owner, kind="stable")
        start, owner = start[order], owner[order]
        out = [np.zeros(len(w), bool) for w in s.words]
        for d, lo, hi in stretches(owner):
            edge = np.zeros(len(out[d]) + 1, np.int32)
            np.add.at(edge, start[lo:hi], 1)
            np.add.at(edge, start[lo:hi] + LENGTH, -1)
            out[d] = np.cumsum(edge[:-1]) > 0
        return out


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 hot_chunks: int = HOT_CHUNKS, chunk_bytes: int = chunks.CHUNK,
                 hot_stretches: int = HOT_STRETCHES) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the remaining words, joined by a space)."""
    packed = chunks.pack(id_text(docs, id_col, text_col), chunk_bytes)
    rounds = Rounds(chunks.buckets(packed, 1 << 20, 1 / 130), chunks.buckets(packed, 6000, 1 / 440),
                    hot_chunks, hot_stretches)
    asked = chunks.ask(packed, rounds.ask_anchors, rounds.answer_anchors, "anchors")
    asked = chunks.ask(asked, rounds.ask_stretches, lambda _, entries: search(entries), "stretches")

    def rows(chunk: Chunk, answers: list) -> pa.RecordBatch:
        gone = rounds.removed(chunk, answers)
        kept = [b" ".join(w for w, g in zip(t.split(), own.tolist()) if not g) for t, own in zip(chunk.texts, gone)]
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(chunk.ids, pa.int64(), mask=chunk.null),
            "n_words": pa.array([len(g) for g in gone], pa.int64()),
            "n_removed": pa.array([int(g.sum()) for g in gone], pa.int64()),
            "kept": pa.array([k.decode() for k in kept], pa.string())})

    return chunks.finish(asked, rows, "doc_id long, n_words long, n_removed long, kept string")


def query(spark, sf_dir: str) -> DataFrame:
    out = deduplicated(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
