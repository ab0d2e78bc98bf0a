"""Ranked search against a plain scoring of every document."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from milepost.llm import lexical_search as ls

DOCS = "doc_id long, text string, n string, m string, bag string, rank string, item string, key string, h string"
ITEMS = "item_id long, text string, doc_id string, score string, key string"
TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def words(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, best=20):
    own = [(i, words(t)) for i, t in docs]
    own = [(i, w, Counter(w)) for i, w in own if w]
    n_docs, total = len(own), sum(len(w) for _, w, _ in own)
    df = Counter(t for _, _, c in own for t in c)
    out = []
    for item, text in items:
        found = []
        for i, w, tf in own:
            m = 75 + 25 * len(w) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                    (10 ** 9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in words(text) if tf[t])
            if s > 0:
                found.append((-s, i is None, i))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:best], 1)]
    return sorted(out, key=repr)


def tables(seed=1):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcéß漢1") for _ in range(r.randint(1, 3))) for _ in range(60)]

    def prose(n):
        return r.choice([" ", ", ", "\n", "\x7f", "_"]).join(r.choice([w, w.upper()]) for w in r.choices(vocab, k=n))

    docs = [(i, prose(r.choice([1, 2, 3, 30, 200]))) for i in range(250)]
    docs += [(i, None) for i in (900, None)] + [(901, ""), (902, " -,. "), (903, "a" * 5000), (904, prose(30000))]
    docs += [(1000 + i, docs[5][1]) for i in range(40)] + [(None, docs[5][1]), (7, docs[5][1]), (7, docs[5][1])]
    items = [(i, prose(r.choice([1, 4, 12]))) for i in range(15)]
    items += [(50, None), (51, ""), (52, "zzzzz"), (53, docs[5][1]), (53, docs[5][1]), (None, docs[6][1]),
              (54, " ".join([vocab[0]] * 30))]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, *["c"] * 7) for i, t in docs], DOCS).repartition(3),
            spark.createDataFrame([(i, t, *["c"] * 3) for i, t in items], ITEMS))


def collected(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [ls.BLOCK_BYTES, 700])
def test_against_brute_force(spark, block_bytes):
    docs, items = tables()
    assert collected(ls.search(*frames(spark, docs, items), block_bytes=block_bytes)) == brute(docs, items)


def test_hot_class(spark):
    docs = [(i, "same words here") for i in range(3000, 0, -1)] + [(5000 + i, f"same {i}") for i in range(60)]
    items = [(1, "same words"), (2, "here"), (3, "same")]
    assert collected(ls.search(*frames(spark, docs, items))) == brute(docs, items)


@pytest.mark.parametrize("empty", ["docs", "items", "both"])
def test_empty_tables(spark, empty):
    docs, items = tables()
    d, i = frames(spark, [] if empty != "items" else docs[:9], [] if empty != "docs" else items)
    assert collected(ls.search(d, i)) == []


def test_scores_are_exact_beyond_doubles():
    bag = np.array([[0, 3], [1, 9]], "<u4").tobytes()
    weight, counts = np.array([20000, 30001]), np.array([[10 ** 6, 1], [10 ** 6, 3]])
    m = np.array([80])
    gain = [20000 * (3 * 10 ** 9 // (3000 + 960)), 30001 * (9 * 10 ** 9 // (9000 + 960))]
    assert ls.score([bag], m, weight, counts).tolist() == [[10 ** 6 * sum(gain), gain[0] + 3 * gain[1]]]
