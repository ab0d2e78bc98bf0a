"""Operator 5: language identification by cross-parsing entropy.

For each language a suffix automaton of its labelled text recognises every
substring of that text.  A document is parsed greedily into longest matches
(phrases); the language whose parse needs the fewest phrases, normalised by
document length and by the size of the language's sample, wins.  Parsed are
lower-cased letters; any run of other characters is one separator, so layout,
digits and symbols speak for no language.

The automata become dense transition tables (one row for each state): a step
that leaves the automaton restarts at the root and counts a phrase.  Documents
are cut into blocks that are parsed side by side, all languages at once, so a
table look-up is one numpy gather for thousands of blocks.  Every block of the
whole text counts.

Fitting uses a bounded sample: per language the documents with the smallest
hash of their id, whole texts in that order up to ``sample_chars`` characters
(the last one is cut there).  Both bounds are parameters.

Defined results: ``und`` with score 0 where the text is null or has no letter,
or where no labelled row exists; ties go to the alphabetically first language;
a null id is never held out; every row gives one row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from milepost.llm.common import bounded, free_name, kept, map_arrow, map_batches, read_table, texts

SAMPLE_DOCS = 24
SAMPLE_CHARS = 24_000
BLOCK = 400
UNKNOWN = "und"
_BREAK = np.int32(1 << 30)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS,
                    sample_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Bounded training text per language from the rows that aren't held out.

    The rank filter is applied in each input partition first, so a language
    with most of the rows is not gathered in one task."""
    rows = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"),
                F.substring(text_col, 1, sample_chars).alias("text"))
    # 16 hash slots per language: each keeps its share, the slots keep the skew out
    ranked = rows.withColumn("h", F.xxhash64("doc_id")).withColumn("slot", F.pmod("h", F.lit(16))) \
        .withColumn("r", F.row_number().over(W.partitionBy("lang", "slot").orderBy("h", "doc_id", "text"))) \
        .where(F.col("r") <= -(-sample_docs // 8)) \
        .withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy("h", "doc_id", "text"))) \
        .where(F.col("r") <= sample_docs)
    out: dict[str, list] = {}
    for x in ranked.select("lang", "r", "text").collect():  # languages x sample_docs rows
        out.setdefault(x.lang, []).append((x.r, x.text))
    return {k: "\n".join(t for _, t in sorted(v))[:sample_chars] for k, v in sorted(out.items())}


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings of ``text``."""
    nexts, link, length, last = [{}], [-1], [0], 0
    for c in text:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                split = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = split
                    p = link[p]
                link[q] = link[cur] = split
        last = cur
    return nexts


def letter_points() -> np.ndarray:
    """Of each code point the lower-case letter's code point; 0 for no letter."""
    point = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            point[i] = ord(low) if len(low) == 1 else i
    return point


def letters(batch: list[str], point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' letters (0: a separator) in one flat array, and each text's length."""
    size = np.array([len(t) for t in batch], np.int64)
    flat = point[np.frombuffer("".join(batch).encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = np.ones(len(flat), bool)
    keep[1:] = (flat[1:] != 0) | (flat[:-1] != 0)
    first = (np.cumsum(size) - size)[size > 0]
    keep[first] = True
    total = np.r_[0, np.cumsum(keep)]
    end = np.cumsum(size)
    return flat[keep], total[end] - total[end - size]


class CrossParser:
    """All languages' tables over one alphabet; symbol 0 is any other letter."""

    def __init__(self, sample: dict[str, str]):
        self.langs = sorted(sample)
        self.point = letter_points()
        own = {k: letters([sample[k]], self.point)[0] for k in self.langs}
        alphabet = np.unique(np.concatenate([[0], *own.values()])).astype(np.int64)
        self.width = len(alphabet) + 1
        self.lookup = np.zeros(0x110000, np.uint16)
        self.lookup[alphabet] = np.arange(1, self.width)
        tables, self.root = [], []
        at = 0
        for lang in self.langs:
            auto = suffix_automaton(self.lookup[own[lang]].tolist())
            root = np.full(self.width, at, np.int32)
            root[[*auto[0]]] = [at + to for to in auto[0].values()]
            table = np.tile(root | _BREAK, (len(auto), 1))
            for state, nexts in enumerate(auto):
                if nexts:
                    table[state, [*nexts]] = [at + to for to in nexts.values()]
            tables.append(table.reshape(-1))
            self.root.append(at)
            at += len(auto)
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
        # longer samples match longer: a phrase costs about log2 of the sample size
        self.cost = np.array([np.log2(len(own[k]) + 2) for k in self.langs])

    def phrases(self, batch: list[str]) -> np.ndarray:
        """Phrases needed, one row per text and one column per language."""
        flat, size = letters(batch, self.point)
        sym = self.lookup[flat].astype(np.int32)
        begin = np.cumsum(size) - size
        blocks = -(-size // BLOCK)
        doc = np.repeat(np.arange(len(batch)), blocks)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at = begin[doc] + nth * BLOCK
        left = np.minimum(BLOCK, size[doc] - nth * BLOCK)
        order = np.argsort(-left, kind="stable")  # blocks end in order: the open ones stay in front
        doc, at, left = doc[order], at[order], left[order]
        n = len(self.langs)
        state = np.tile(np.array(self.root, np.int32), (len(doc), 1))
        count = np.zeros((len(doc), n), np.int32)
        open_at = np.searchsorted(-left, -np.arange(1, BLOCK + 1), side="right")
        for i in range(BLOCK):
            k = open_at[i]
            if not k:
                break
            step = self.table[state[:k].astype(np.int64) * self.width + sym[at[:k] + i][:, None]]
            count[:k] += step >> 30
            state[:k] = step & (_BREAK - 1)
        count += 1  # the phrase still open at a block's end
        total = np.zeros((len(batch), n), np.int64)
        np.add.at(total, doc, count)
        return total

    def predict(self, batch: list[str | None]) -> tuple[list[str], np.ndarray]:
        named = [t if t is not None and any(map(str.isalpha, t)) else "" for t in batch]
        lang, score = [UNKNOWN] * len(batch), np.zeros(len(batch))
        if not self.langs:
            return lang, score
        bits = self.phrases(named) * self.cost
        best = bits.argmin(axis=1)
        for i, t in enumerate(named):
            if t:
                lang[i] = self.langs[best[i]]
                total = (1.0 / bits[i]).sum()
                score[i] = float(1.0 / bits[i, best[i]] / total)
        return lang, score


def _parser(sample: dict[str, str]) -> CrossParser:
    return kept(("parser", tuple(sample.items())), lambda: CrossParser(sample))


def predict(docs: DataFrame, sample: dict[str, str], id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row, from the text alone."""
    def run(batch):
        lang, score = _parser(sample).predict(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "lang_pred": lang, "score": score}

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(own, run, "doc_id long, lang_pred string, score double", limit=1 << 20)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    sample = labelled_sample(docs, id_col, text_col, lang_col)
    return predict(docs, sample, id_col, text_col).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def keep_recognised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text a language is found for; where no row
    is labelled nothing can be learned, and all texts with a letter stay."""
    from pyspark.sql.types import StringType, StructField, StructType

    sample = labelled_sample(docs)
    name = free_name("lang_found", docs.columns)

    def run(batches):
        for batch in bounded(batches, limit=1 << 20):
            own = texts(batch)
            lang, _ = _parser(sample).predict(own)
            if not sample:
                lang = ["" if any(map(str.isalpha, t)) else UNKNOWN for t in own]
            yield batch.append_column(name, pa.array(lang, pa.string()))

    schema = StructType([*docs.schema.fields, StructField(name, StringType())])
    return map_batches(docs, run, schema).where(F.col(name) != UNKNOWN).drop(name)


def query(spark, sf_dir: str) -> DataFrame:
    return language_id(read_table(spark, sf_dir, "documents"))
