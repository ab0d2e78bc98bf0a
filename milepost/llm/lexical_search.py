"""Operator 13: ranked lexical search with bag deduplication.

A document's score depends only on how often it has the items' terms and on its
length weight m.  So every document is cut down to its bag: the counts of the terms
that some item has.  Documents with equal bags and equal m are one class (found by
hash, verified by comparing the bags themselves); a class is scored once against
all items, and only the classes that lead for an item are expanded to their
members, by ascending id.  An item's best documents lie in its best classes
ordered by (score, smallest id): a class beyond that many has that many documents
before it.

Items come in blocks whose terms fit a stated number of bytes (``BLOCK_BYTES``),
each block one pass over the documents; a block's terms, their weights and the
counts per item are all that goes to tasks and driver.  The statistics N, L and df
are counted over all documents.

Skew: classes are merged in partial sums; leading classes are kept per task before
the shuffle (``best`` per item); members of a hot class are cut to the ``best``
smallest ids in each task before they meet.

Defined results: null or termless text has no bag and no rank; a null id ranks
after all ids of its score; rows with equal ids are ranked each for itself; items
without terms or matches give no rows; items with equal or null ids are ranked
each for itself; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from milepost.llm.common import bounded, checkpointed, id_text, map_batches, read_table, utf8
from milepost.session import ensure_checkpoint_dir, remove_folder

BEST = 20
BLOCK_BYTES = 8 << 20  # text bytes of the items searched in one pass
BROADCAST_BYTES = 32 << 20  # of leading classes, at most ``best`` per item of a block
SCORED = 512  # classes scored at once
NO_ID = np.iinfo(np.int64).max

# Bytes: letters and digits stay (A-Z become a-z), all of a non-ASCII character is
# 0x80 or above and stays, everything else parts terms.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split()


class Items:
    """A block of items: vocabulary, and each item's term counts."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.keys = [k for k, _ in rows]  # of the items, in the order of the columns of ``counts``
        words = [Counter(terms(t)) for _, t in rows]
        self.vocabulary = {w: i for i, w in enumerate(sorted(set().union(*words)))}
        self.counts = np.zeros((len(self.vocabulary), len(rows)), np.int64)
        for j, c in enumerate(words):
            for w, n in c.items():
                self.counts[self.vocabulary[w], j] = n

    def bag(self, words: list[bytes]) -> bytes:
        """(term, count) pairs by term, four bytes each."""
        found = Counter(map(self.vocabulary.get, words))
        found.pop(None, None)
        return np.array(sorted(found.items()), "<u4").tobytes()


def unbag(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(raw, "<u4").reshape(-1, 2).astype(np.int64)
    return both[:, 0], both[:, 1]


def bags(docs: DataFrame, items: Items) -> DataFrame:
    """doc_id, n, bag of every document that has a term."""
    def run(batches):
        for batch in bounded(batches):
            words = [terms(t) for t in utf8(batch)]
            keep = [i for i, w in enumerate(words) if w]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").take(pa.array(keep, pa.int64())),
                "n": pa.array([len(words[i]) for i in keep], pa.int64()),
                "bag": pa.array([items.bag(words[i]) for i in keep], pa.binary())})

    return map_batches(docs, run, "doc_id long, n long, bag binary")


def statistics(found: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and df of each term, over all documents."""
    def run(batches):
        df, n, all_n = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for raw in batch.column("bag").to_pylist():
                df[unbag(raw)[0]] += 1
            n += batch.num_rows
            all_n += int(batch.column("n").to_numpy().sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(np.r_[-2, -1, some], pa.int64()),
                                          "amount": pa.array(np.r_[n, all_n, df[some]], pa.int64())})

    rows = map_batches(found.select("n", "bag"), run, "term long, amount long").groupBy("term").agg(
        F.sum("amount").alias("amount")).collect()
    df, total = np.zeros(size, np.int64), {-2: 0, -1: 0}
    for r in rows:
        if r.term < 0:
            total[r.term] = r.amount
        else:
            df[r.term] = r.amount
    return total[-2], total[-1], df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def score(raws: list[bytes], m: np.ndarray, weight: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Scores of classes (rows) for items (columns), in exact integers."""
    part = [unbag(r) for r in raws]
    row = np.repeat(np.arange(len(raws)), [len(t) for t, _ in part])
    term = np.concatenate([t for t, _ in part])
    tf = np.concatenate([c for _, c in part])
    gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
    used = np.unique(term)
    table = np.zeros((len(raws), len(used)), np.int64)
    table[row, np.searchsorted(used, term)] = gain
    counts = counts[used]
    if gain.max(initial=0) * counts.sum(axis=0).max(initial=0) < 1 << 53:  # doubles are exact
        return (table.astype(float) @ counts.astype(float)).astype(np.int64)
    return table @ counts


def leaders(classes: DataFrame, items: Items, weight: np.ndarray, best: int) -> DataFrame:
    """item (place in the block), score, low and key of the classes that may hold
    one of the item's ``best`` documents."""
    counts, n_items = items.counts, items.counts.shape[1]

    def run(batches):
        held = [np.zeros((0, 3), np.int64) for _ in range(n_items)]  # score, low, row
        keys, kept_bags, kept_m = np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, SCORED):
                part = batch.slice(i, SCORED)
                raws, m = part.column("bag").to_pylist(), part.column("m").to_numpy()
                low = part.column("low").fill_null(NO_ID).to_numpy()
                found = score(raws, m, weight, counts)
                base = len(kept_m)
                kept_bags = np.concatenate([kept_bags, np.array([*raws, None], object)[:-1]])
                kept_m = np.r_[kept_m, m]
                for j in range(n_items):
                    own = np.flatnonzero(found[:, j] > 0)
                    if not len(own):
                        continue
                    if len(held[j]) == best:  # only what beats the last one held
                        own = own[found[own, j] >= held[j][-1, 0]]
                    rows = np.concatenate([held[j], np.stack([found[own, j], low[own], base + own], axis=1)])
                    held[j] = rows[np.lexsort((rows[:, 1], -rows[:, 0]))[:best]]
                used = np.unique(np.concatenate([h[:, 2] for h in held])) if n_items else keys
                kept_bags, kept_m = kept_bags[used], kept_m[used]
                for h in held:
                    h[:, 2] = np.searchsorted(used, h[:, 2])
        for j, h in enumerate(held):
            yield pa.RecordBatch.from_pydict({
                "item": pa.array([j] * len(h), pa.int32()), "score": pa.array(h[:, 0], pa.int64()),
                "low": pa.array(h[:, 1], pa.int64()), "m": pa.array(kept_m[h[:, 2]], pa.int64()),
                "bag": pa.array(list(kept_bags[h[:, 2]]), pa.binary())})

    found = map_batches(classes, run, "item int, score long, low long, m long, bag binary")
    first = W.partitionBy("item").orderBy(F.desc("score"), "low")
    return found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= best).drop("place", "low")


def _search(docs: DataFrame, items: Items, best: int) -> DataFrame:
    """item (place in the block), rank, doc_id, score."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/bags-{uuid.uuid4().hex}"
    bags(docs, items).write.parquet(folder)
    found = spark.read.parquet(folder)
    n_docs, all_terms, df = statistics(found, len(items.vocabulary))
    # 100 - 25 + 25 * n * N div L, beyond a long in very large corpora
    m = F.lit(75) + F.expr(f"cast((cast(25 as decimal(38,0)) * n * {n_docs}) div {max(all_terms, 1)} AS bigint)")
    found = found.where(F.octet_length("bag") > 0).withColumn("m", m)
    classes = found.groupBy(F.xxhash64("bag", "m").alias("h"), "bag", "m").agg(F.min("doc_id").alias("low"))
    ahead = checkpointed(leaders(classes.select("bag", "m", "low"), items, weights(n_docs, df), best))
    wanted = ahead.select("bag", "m").distinct().withColumn("h", F.xxhash64("bag", "m"))
    if (wanted.agg(F.sum(F.octet_length("bag").cast("long") + 16)).first()[0] or 0) <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)  # then members of a hot class are cut before they move
    smallest = W.partitionBy("h", "bag", "m").orderBy(F.col("doc_id").asc_nulls_last())
    members = found.withColumn("h", F.xxhash64("bag", "m")).join(wanted, ["h", "bag", "m"], "left_semi") \
        .withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= best).drop("place")
    order = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    out = checkpointed(ahead.join(members.select("bag", "m", "doc_id"), ["bag", "m"])
                       .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
                       .select("item", "rank", "doc_id", "score"))
    remove_folder(spark, folder)
    return out


def search(docs: DataFrame, items: DataFrame, best: int = BEST, block_bytes: int = BLOCK_BYTES,
           id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``best`` documents."""
    spark = docs.sparkSession
    base = id_text(docs, id_col, text_col)
    own = checkpointed(items.select(F.col(item_col).alias("item_id"), F.col("text").cast("string").alias("text"))
                       .where("text IS NOT NULL").withColumn("key", F.monotonically_increasing_id()))
    size = own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = size // block_bytes + 1
    out = None
    for b in range(blocks):
        rows = own.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b) if blocks > 1 else own
        block = Items([(r.key, r.text.encode()) for r in rows.select("key", "text").collect()])
        if not block.vocabulary:
            continue
        keys = spark.createDataFrame(list(enumerate(block.keys)), "item int, key long")
        found = _search(base, block, best).join(keys, "item").drop("item")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "rank int, doc_id long, score long, key long")
    return out.join(own.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n FROM (SELECT doc_id, {_SPLIT} AS w FROM documents)
           WHERE len(w) > 0),
al AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM d),
tf AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d)
       GROUP BY doc_id, term),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS wt
       FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), al),
m AS (SELECT doc_id, 75 + (25 * n * docs) // words AS m FROM d, al),
it AS (SELECT item_id, unnest({_SPLIT}) AS term FROM benchmark),
sc AS (SELECT item_id, doc_id, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
       FROM it JOIN wt USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
rk AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score FROM sc WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM rk WHERE rank <= {BEST}
"""
