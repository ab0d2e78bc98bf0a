"""Operator 1: benchmark decontamination by a prefix-filtered set join.

Each window of an item (10 consecutive words; the whole item where it has
fewer) is a set of word shingles.  Containment of all of them is asked for, so
one necessary prefix token per window suffices: its rarest shingle, by the
shingles' counts over all documents.  A document shingle that meets a prefix
token gives a candidate start (positional bound), which must leave room for the
window inside the document (length bound); the words are then compared exactly.

Two passes over the documents, neither with a shuffle of texts: one counts the
items' shingles, one joins.  The items are the stated query side; they are
handled in blocks of at most ``block_words`` words, and only a block's index is
broadcast.  Blocks follow one another on the same rows, so hits of several
blocks unite row by row, and a hot document, item or passage moves nothing.

Defined results: null text has no words (0, 0, 0, hash of the empty string,
false); every row gives one row, repeated rows included; a null doc_id stays
null; items with null id mark words but are not listed; repeated item ids count
once; no items: nothing is hit; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import bounded, id_text, map_arrow, map_batches, read_table, utf8
from milepost.llm.wordhash import shingle_hashes, span_hashes, spans

WINDOW = 10
SHINGLE = 5
BLOCK_WORDS = 2_000_000

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


class Words:
    """Words of a batch of texts: byte spans, hashes, and each text's first word."""

    def __init__(self, batch: list[bytes]):
        self.raw = b"\0".join([*batch, b""]).lower()  # bytes.lower() touches A-Z only
        flat = np.frombuffer(self.raw, np.uint8)
        self.start, self.end = spans(_WORD[flat])
        self.hash = span_hashes(flat, self.start, self.end)
        length = np.array([len(b) + 1 for b in batch], np.int64)
        self.first = np.searchsorted(self.start, np.r_[0, np.cumsum(length)])

    def text(self, i: int, n: int) -> bytes:
        return b" ".join(self.raw[a:b] for a, b in zip(self.start[i:i + n], self.end[i:i + n]))


class Windows:
    """A block of items: their windows, shingles, and (once the corpus counts are
    known) the prefix tokens with the windows and offsets they stand for."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int, shingle: int):
        words = Words([(t or "").encode() for _, t in items])
        found: dict[bytes, tuple[int, int]] = {}
        self.items: list[set[str]] = []
        for (name, _), lo, hi in zip(items, words.first[:-1], words.first[1:]):
            n = min(window, hi - lo)
            for i in range(lo, hi - n + 1) if n else ():
                text = words.text(i, n)
                w = found.setdefault(text, (len(found), n))[0]
                if w == len(self.items):
                    self.items.append(set())
                if name is not None:
                    self.items[w].add(name)
        self.text = list(found)
        self.size = np.array([n for _, n in found.values()], np.int64)
        # shingles of each window: width, hash, window, offset
        rows = {}
        for w, (text, n) in enumerate(zip(self.text, self.size)):
            k = min(shingle, int(n))
            h = shingle_hashes(Words([text]).hash, k)
            rows.setdefault(k, []).extend((int(x), w, o) for o, x in enumerate(h))
        self.width = {}
        for k, r in sorted(rows.items()):
            h = np.array([x[0] for x in r], np.uint64)
            self.width[k] = (h, np.array([x[1] for x in r]), np.array([x[2] for x in r]), np.unique(h))

    def counts(self, words: Words) -> dict[int, np.ndarray]:
        """Occurrences in a batch of each distinct shingle, by width."""
        out = {}
        for k, (_, _, _, distinct) in self.width.items():
            at = _find(distinct, _within(words, k)[0])
            out[k] = np.bincount(at[at >= 0], minlength=len(distinct))
        return out

    def index(self, rarity: dict[int, np.ndarray]) -> "Windows":
        """Keep each window's rarest shingle (ties: the first) as its prefix token."""
        self.prefix = {}
        for k, (h, w, o, distinct) in self.width.items():
            rare = rarity[k][np.searchsorted(distinct, h)]
            order = np.lexsort((o, rare, w))
            pick = order[np.unique(w[order], return_index=True)[1]]
            pick = pick[np.argsort(h[pick], kind="stable")]
            token, first, n = np.unique(h[pick], return_index=True, return_counts=True)
            self.prefix[k] = (token, first, n, w[pick], o[pick])
        return self

    def join(self, words: Words) -> list[tuple[int, int]]:
        """(first word, window) of every exact occurrence in a batch of texts."""
        out = []
        for k, (token, first, n, window, offset) in self.prefix.items():
            h, place = _within(words, k)
            at = _find(token, h)
            hit = np.flatnonzero(at >= 0)
            if not len(hit):
                continue
            fan = n[at[hit]]
            entry = np.repeat(first[at[hit]] - (np.cumsum(fan) - fan), fan) + np.arange(fan.sum())
            place = np.repeat(place[hit], fan)
            start, w = place - offset[entry], window[entry]
            doc = np.searchsorted(words.first, place, side="right") - 1
            inside = (start >= words.first[doc]) & (start + self.size[w] <= words.first[doc + 1])
            out += [(i, j) for i, j in zip(start[inside].tolist(), w[inside].tolist())
                    if words.text(i, int(self.size[j])) == self.text[j]]
        return out


def _find(sorted_values: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted values; -1 where it's not there."""
    if not len(sorted_values):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(sorted_values, h), len(sorted_values) - 1)
    return np.where(sorted_values[at] == h, at, -1)


def _within(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of the shingles of width k that lie in one document."""
    h = shingle_hashes(words.hash, k)
    place = np.arange(len(h))
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    own = doc[:len(h)] == doc[k - 1:k - 1 + len(h)]
    return h[own], place[own]


def _blocks(items: DataFrame, limit: int):
    """The items in blocks of bounded size, in id order, streamed to the driver."""
    block, size = [], 0
    for x in items.orderBy("item", "text").toLocalIterator():
        n = len((x.text or "").split()) + 1
        if block and size + n > limit:
            yield block
            block, size = [], 0
        block.append((x.item, x.text))
        size += n
    yield block


def _rarity(docs: DataFrame, block: Windows) -> dict[int, np.ndarray]:
    """Counts over all documents of the block's shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batch):
        width, place, n = [], [], []
        for k, c in shared.value.counts(Words(utf8(batch))).items():
            some = np.flatnonzero(c)
            width += [k] * len(some)
            place += some.tolist()
            n += c[some].tolist()
        return {"width": width, "place": place, "n": n}

    out = {k: np.zeros(len(v[3]), np.int64) for k, v in block.width.items()}
    seen = map_arrow(docs, run, "width int, place long, n long")
    for x in seen.groupBy("width", "place").agg(F.sum("n").alias("n")).toLocalIterator():
        out[x.width][x.place] = x.n
    return out


def _indexed(docs: DataFrame, rows: list, window: int, shingle: int):
    """Broadcast prefix index of a block of items."""
    block = Windows(rows, window, shingle)
    block.index(_rarity(docs, block))
    block.width = {}
    return docs.sparkSession.sparkContext.broadcast(block)


def contaminated_words(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                       window: int = WINDOW, shingle: int = SHINGLE,
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, hits (one bit per word, packed), items (array, as strings)."""
    state = id_text(docs, id_col, text_col).withColumns(
        {"n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"), "hits": F.lit(None).cast("binary"),
         "items": F.array().cast("array<string>")})
    own = items.select(F.col(item_id).cast("string").alias("item"),
                       F.col(item_text).cast("string").alias("text"))
    base = id_text(docs, id_col, text_col)
    schema = "doc_id long, text string, n_words long, n_hit long, hits binary, items array<string>"
    for rows in _blocks(own, block_words):
        shared = _indexed(base, rows, window, shingle)

        def run(batch, shared=shared):
            block = shared.value
            words = Words(utf8(batch))
            cover = np.zeros(len(words.hash) + 1, np.int64)
            names = [set(x) for x in batch.column("items").to_pylist()]
            for i, w in block.join(words):
                cover[i] += 1
                cover[i + block.size[w]] -= 1
                doc = int(np.searchsorted(words.first, i, side="right")) - 1
                names[doc] |= block.items[w]
            hit = np.cumsum(cover[:-1]) > 0
            bits, n_hit = [], []
            for lo, hi, old in zip(words.first[:-1], words.first[1:], batch.column("hits").to_pylist()):
                own = np.packbits(hit[lo:hi])
                both = own | np.frombuffer(old, np.uint8) if old else own
                bits.append(both.tobytes())
                n_hit.append(int(np.unpackbits(both).sum()))
            return {"doc_id": batch.column("doc_id"), "text": batch.column("text"),
                    "n_words": np.diff(words.first), "n_hit": n_hit, "hits": bits,
                    "items": pa.array([sorted(x) for x in names], pa.list_(pa.string()))}

        state = map_arrow(state, run, schema)
    return state.select("doc_id", "n_words", "n_hit", "hits", "items")


def keep_clean(docs: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of any item."""
    base = id_text(docs)
    own = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    out = docs
    for rows in _blocks(own, block_words):
        shared = _indexed(base, rows, WINDOW, SHINGLE)

        def run(batches, shared=shared):
            for batch in bounded(batches):
                words = Words(utf8(batch))
                start = np.array([i for i, _ in shared.value.join(words)], np.int64)
                clean = np.ones(batch.num_rows, bool)
                clean[np.searchsorted(words.first, start, side="right") - 1] = False
                yield batch.filter(pa.array(clean))

        out = map_batches(out, run, docs.schema)
    return out


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = contaminated_words(docs, items)
    return found.select(
        "doc_id", "n_words", F.col("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def query(spark, sf_dir: str) -> DataFrame:
    return digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


# Every window of every item against every run of words of the same length.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
b AS (SELECT item_id, {_SPLIT} AS w FROM benchmark),
sized AS (SELECT item_id, w, least({WINDOW}, len(w)) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
pos AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
              FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, pos.n AS n, item_id FROM pos JOIN win USING (n, g)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit
                WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN names USING (doc_id)
"""
