"""The corpus pipeline against plain Python, and its registration."""
import hashlib

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from milepost.llm import secret_scan
from tests.llm.test_operators import slow_components, slow_fingerprint


def test_registered():
    names = {n.split("_")[0] for n in E.queries()}
    assert {f"op{i}" for i in range(1, 14)} <= names and "pipeline" in E.queries()


def test_decontamination_oracle(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    want = con.execute(E.oracle_sql()["op1_decontaminate"]).df()
    got = E.queries()["op1_decontaminate"](spark, "/root/testdata/sf0.001").toPandas()[list(want.columns)]
    assert got.sort_values("doc_id").reset_index(drop=True).equals(want.sort_values("doc_id").reset_index(drop=True))


def test_pipeline(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    from milepost.llm.bpe_tables import default_path
    import re
    lib = tokenizers.Tokenizer.from_file(default_path())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = [(9001, None), (9002, "12 !!"), (9003, 'token = "abcdef0123456789"  word word word word')]
    more = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in extra], docs.schema)
    docs.union(more).withColumn("rank", docs["doc_id"]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))

    own = {x.doc_id: x.text for x in docs.union(more).collect() if x.text and any(map(str.isalpha, x.text))}
    fp = {i: slow_fingerprint(t) for i, t in own.items()}
    group = slow_components(set(fp.values()), 4)
    least = {}
    for i, f in fp.items():
        least[group[f]] = min(i, least.get(group[f], i))
    own = {i: t for i, t in own.items() if least[group[fp[i]]] == i}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(
        str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    win = set()
    for x in spark.read.parquet(str(tmp_path / "benchmark.parquet")).collect():
        w = words(x.text)
        n = min(10, len(w))
        win |= {tuple(w[s:s + n]) for s in range(len(w) - n + 1)}
    sizes = {len(x) for x in win}
    own = {i: t for i, t in own.items() if not any(
        tuple(w[s:s + n]) in win for w in [words(t)] for n in sizes for s in range(len(w) - n + 1))}
    want = {}
    for i, t in own.items():
        done, out = 0, ""
        for a, _, b in secret_scan.scan(t):
            if a >= done:
                out += t[done:a] + "[secret]"
            done = max(done, b)
        out += t[done:]
        ids = lib.encode(out, add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(out.encode()).hexdigest())
    got = {x.doc_id: (x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want
    assert len(got) < docs.count() and 9003 in got


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20).withColumn("lang_found", docs_col())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns, name


def docs_col():
    from pyspark.sql import functions as F
    return F.lit("x")


def test_near_duplicate_stage_with_odd_ids(spark):
    from milepost.llm import simhash
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (None, "a b c d e"), (None, "x y z v w"),
            (None, "x y z v w"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", *[f"'x' AS {c}" for c in ("keep_id", "Label", "fp", "rank", "n", "component_id", "least")])
    got = simhash.keep_one(docs).collect()
    assert sorted((repr(x.doc_id), x.text) for x in got) == [("1", "a b c d e"), ("3", None), ("None", "x y z v w")]


def test_near_duplicate_stage_keeps_one_row_of_every_group(spark):
    from milepost.llm import simhash
    rows = [(7, "apple pear plum fig lime"), (7, "zebra lion wolf bear lynx"), (7, "zebra lion wolf bear lynx"),
            (2, "copy of one text here"), (8, "copy of one text here"), (8, "alone in its own group"),
            (None, "zebra lion wolf bear lynx"), (None, "without any id at all")]
    want = [(2, rows[3][1]), (7, rows[0][1]), (7, rows[1][1]), (8, rows[5][1]), (None, rows[7][1])]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", *[f"'x' AS {c}" for c in ("keep_id", "Label", "fp", "rank", "n", "key_id", "key_fp", "least")])).collect()
    assert sorted(((x.doc_id, x.text) for x in got), key=repr) == sorted(want, key=repr)


def test_language_stage_with_clashing_columns(spark):
    from milepost.llm import langid
    rows = [(i, "the cat and the dog", "en", "x") for i in range(9)] + [(9, None, "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, Lang_Found string")
    got = langid.keep_recognised(docs)
    assert got.columns == docs.columns and got.count() == 9


CLASHING = ("lang string, source string, n_chars long, n_tokens string, ids string, ids_sha256 string, Lang_Found string, "
            "fp string, Rank string, n string, item string, items string, spans string, clean string")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_empty_and_clashing_tables(spark, name, stage):
    schema = f"doc_id long, text string, {CLASHING}"
    rows = [(i, t, "en", "s", 0, *["x"] * 11) for i, t in
            [(1, "the cat sat on the mat today"), (1, "the cat sat on the mat today"), (None, "a dog ran in the park"), (4, None), (5, "")]]
    last = name == corpus_pipeline.STAGES[-1][0]
    for data in ([], rows):
        docs = spark.createDataFrame(data, schema)
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns[:len(docs.columns)] == docs.columns and (last or out.columns == docs.columns)
        assert out.count() <= len(data) and (not data or out.count())
    if last:
        assert out.columns[-4:] == ["n_tokens_", "ids_", "ids_sha256_", "decoded_sha256"]
        empty = hashlib.sha256(b"").hexdigest()
        assert sum(r.decoded_sha256 == empty and r["n_tokens_"] == 0 for r in out.collect()) == 2


def test_unlabelled_corpus_keeps_its_texts(spark):
    from milepost.llm import langid
    rows = [(i, t, None) for i, t in enumerate(["the cat", "123 !!", None, "", "дом"])]
    got = langid.keep_recognised(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r.text for r in got.collect()} == {"the cat", "дом"}
