"""The ten operators against brute force on small tables that hold nulls, empty
and long texts, ties, repeated rows and extra columns with clashing names."""
import hashlib
import random

import numpy as np
import pytest
import xxhash

from milepost.llm import (
    bpe_codec, decontaminate, langid, minhash, pii, secret_scan, simhash, substring_fm, suffix_dedup, token_count)

SCHEMA = ("doc_id long, text string, lang string, fp string, kept string, n_tokens string, "
          "items string, rank string, label string, chunk string, entities string, score string")
OPERATORS = {
    "op1": lambda d: decontaminate.digest(d, d.selectExpr("doc_id AS item_id", "text")),
    "op2": substring_fm.deduplicated, "op3": simhash.digest, "op4": bpe_codec.digest, "op5": langid.language_id,
    "op6": secret_scan.digest, "op7": lambda d: pii.replace_entities(d, "k"), "op8": token_count.token_counts,
    "op9": suffix_dedup.deduplicated, "op10": minhash.edited_fingerprints}


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, lang, *["x"] * 9) for i, t, lang in rows], SCHEMA).repartition(parts)


def corpus(seed=1):
    """Texts with shared passages, copies, near copies, and the odd cases."""
    r = random.Random(seed)
    word = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6))) for _ in range(400)]

    def prose(n):
        return " ".join(r.choice(word) for _ in range(n))

    passage, line = prose(70), prose(54)
    rows = [(None, None, None), (None, prose(60), "en"), (1, "", "en"), (2, "  \t\n ", "en"), (3, "123 !!", "fr")]
    for i in range(10, 70):
        t = prose(r.choice([3, 8, 40, 90, 200]))
        if i % 3 == 0:
            t += "\n" + passage
        if i % 4 == 0:
            t = t + "  " + line + "\t" + prose(20)
        rows.append((i, t, r.choice(["en", "fr", None])))
    big = prose(6000)
    rows += [(100, big, "en"), (101, big[:15000] + prose(5) + big[15000:], "en"), (102, rows[20][1], "fr"),
             (103, "a" * 4000, "en"), (104, "ab" * 900 + "a" * 300, "en")]
    return rows + rows[6:9]


@pytest.fixture(scope="module")
def rows():
    return corpus()


def collected(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


@pytest.mark.parametrize("op", OPERATORS)
def test_empty_table(spark, op):
    assert OPERATORS[op](spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("op", OPERATORS)
def test_rows_are_kept_and_equal_runs_agree(spark, rows, op):
    once = collected(OPERATORS[op](frame(spark, rows)))
    assert sorted((x[0] for x in once), key=repr) == sorted((i for i, _, _ in rows), key=repr)
    assert once == collected(OPERATORS[op](frame(spark, rows, 7)))


def smaller_windows(rows, units, n):
    """{(id, text): (units, removed flags)} by brute force."""
    order = lambda i: float("inf") if i is None else i
    least, out = {}, {}
    for i, t, _ in rows:
        u = units(t)
        for s in range(len(u) - n + 1):
            k = u[s:s + n] if isinstance(u, bytes) else tuple(u[s:s + n])
            least[k] = min(least.get(k, float("inf")), order(i))
    for i, t, _ in rows:
        u = units(t)
        gone = [False] * len(u)
        for s in range(len(u) - n + 1):
            k = u[s:s + n] if isinstance(u, bytes) else tuple(u[s:s + n])
            if least[k] < order(i):
                gone[s:s + n] = [True] * n
        out[i, t] = u, gone
    return out


@pytest.mark.parametrize("chunk_bytes,hot", [(2 << 20, 2000), (3000, 2000), (3000, 1)])
def test_substring_fm(spark, rows, chunk_bytes, hot):
    want = [(i, len(u), sum(g), b" ".join(w for w, x in zip(u, g) if not x).decode()) for (i, t), (u, g) in (
        ((i, t), smaller_windows(rows, lambda t: (t or "").encode().split(), 50)[i, t]) for i, t, _ in rows)]
    got = collected(substring_fm.deduplicated(frame(spark, rows), hot_chunks=hot, chunk_bytes=chunk_bytes))
    assert got == sorted(want, key=repr)
    assert sum(x[2] for x in got) > 500


def test_substring_fm_spreads_a_phrase_that_one_chunk_holds_often():
    from milepost.llm.chunks import Chunk
    r = random.Random(3)
    phrase = b" ".join(b"p%d" % i for i in range(44))
    texts = [b" ".join([*(b"%x" % r.getrandbits(40) for _ in range(12)), phrase,
                        *(b"%x" % r.getrandbits(40) for _ in range(12))]) for _ in range(3000)]
    chunk = Chunk(np.arange(len(texts)), np.zeros(len(texts), bool), texts)
    rounds = substring_fm.Rounds(2, 64, substring_fm.HOT_CHUNKS)
    replies = b"".join(rounds.answer_anchors(b, [e])[0] for b, e in rounds.ask_anchors(chunk, []))
    sent = [len(substring_fm._unpack(e)[0]) for _, e in rounds.ask_stretches(chunk, [replies])]
    assert len(sent) == 64 and max(sent) < 2 * sum(sent) / 64


def test_substring_fm_cuts_anchors_by_their_stretches(spark, rows):
    whole = collected(substring_fm.deduplicated(frame(spark, rows)))
    assert collected(substring_fm.deduplicated(frame(spark, rows), hot_stretches=1)) == whole


def test_chunks_keep_their_numbers_when_a_task_runs_again(spark, rows):
    from milepost.llm import chunks
    docs = frame(spark, rows).select("doc_id", "text")
    once, again = (sorted((x.chunk, bytes(x.data)) for x in chunks.pack(docs, 3000).collect()) for _ in range(2))
    assert once == again and len({n for n, _ in once}) == len(once) > 20


@pytest.mark.parametrize("chunk_bytes", [2 << 20, 3000])
def test_suffix_dedup(spark, rows, chunk_bytes):
    truth = smaller_windows(rows, lambda t: (t or "").encode(), 50)
    want = []
    for i, t, _ in rows:
        u, g = truth[i, t]
        spans = sum(x and not y for x, y in zip(g, [False, *g]))
        want.append((i, len(u), sum(g), spans, bytes(b for b, x in zip(u, g) if not x)))
    got = [(*x[:4], bytes(x[4])) for x in suffix_dedup.deduplicated(frame(spark, rows), chunk_bytes=chunk_bytes).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_decontaminate(spark, rows):
    import re
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    items = [(i, " ".join((t or "").split()[3:17]).upper()) for i, t, _ in rows[8:30]] + [
        (5, None), (6, "..."), (7, "Aé c"), (None, rows[31][1]), (8, rows[31][1]), (8, rows[31][1])]
    win = {}
    for name, t in items:
        w = words(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            win.setdefault(tuple(w[s:s + n]), set()).add(name)
    want = []
    for i, t, _ in rows:
        w, hit, names = words(t), set(), set()
        for n in {len(k) for k in win}:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s:s + n])) in win:
                    hit |= {*range(s, s + n)}
                    names |= win[k]
        names = sorted(str(x) for x in names if x is not None)
        want.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert collected(decontaminate.digest(frame(spark, rows), bench)) == sorted(want, key=repr)
    # several blocks give the same, and the filter keeps what is clean
    some = decontaminate.contaminated_words(frame(spark, rows), bench, block_words=60)
    assert collected(some.select("doc_id", "n_words", "n_hit")) == sorted(((*x[:3],) for x in want), key=repr)
    kept = decontaminate.keep_clean(frame(spark, rows), bench, block_words=60)
    assert sorted((repr(x.doc_id) for x in kept.collect())) == sorted(repr(x[0]) for x in want if not x[5])
    none = decontaminate.digest(frame(spark, rows), bench.where("false"))
    assert none.where("contaminated").count() == 0 and none.count() == len(rows)


def slow_fingerprint(t):
    w = (t or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def slow_components(fps, distance):
    todo, out = set(fps), {}
    while todo:
        group, edge = set(), {todo.pop()}
        while edge:
            group |= edge
            edge = {x for x in todo if any((x ^ y).bit_count() <= distance for y in edge)}
            todo -= edge
        out |= dict.fromkeys(group, frozenset(group))
    return out


def test_simhash(spark, rows):
    own = [(i, slow_fingerprint(t)) for i, t, _ in rows]
    group = slow_components({f for _, f in own}, 4)
    least = {g: min((i for i, f in own if f in g and i is not None), default=None) for g in set(group.values())}
    want = [(i, f"{f:016x}", least[group[f]]) for i, f in own]
    assert collected(simhash.digest(frame(spark, rows))) == sorted(want, key=repr)


def test_simhash_links_random_fingerprints(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(12)]
    fps = {b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 5))) for b in base for _ in range(25)}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    links = simhash.links(spark.createDataFrame(signed, "fp long"))
    from milepost.llm.components import components
    label = {x.node % (1 << 64): x.label % (1 << 64) for x in components(links).collect()}
    group = slow_components(fps, 4)
    for f in fps:
        smallest = min(group[f], key=lambda x: x - (1 << 64) if x >> 63 else x)
        assert label.get(f, f) == smallest


def test_components_of_a_path_and_a_star(spark):
    from milepost.llm.components import components
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {x.node: x.label for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 if i <= 40 else 100 for i in [*range(41), *range(100, 160)]}


ODD = ["<|endoftext|>a<|endoftext|><|endo", "aaaaaaaaaaaaaaaaa it's 'S we'll  \n\n x\t\ty ", "日本語 𝟘𝟙 ½Ⅷ\x85\x1c z", "\x00\x01é́"]


def test_bpe_codec_and_token_count(spark, rows):
    tokenizers = pytest.importorskip("tokenizers")
    from milepost.llm.bpe_tables import default_path
    lib = tokenizers.Tokenizer.from_file(default_path())
    more = rows + [(200 + k, t, None) for k, t in enumerate(ODD)]
    ids = [lib.encode(t or "", add_special_tokens=False).ids for _, t, _ in more]
    docs = frame(spark, more)
    want = sorted(((i, len(x), np.array(x, "<u4").tobytes(), lib.decode(x, skip_special_tokens=False))
                   for (i, _, _), x in zip(more, ids)), key=repr)
    for coded in (bpe_codec.round_trip(docs), bpe_codec.decode(bpe_codec.encode(docs))):
        assert sorted(((a, n, bytes(b), t) for a, n, b, t in coded.collect()), key=repr) == want
    assert collected(token_count.token_counts(docs, limit=40)) == sorted(
        ((i, len((t or "").encode()), len(x), len(x) > 40) for (i, t, _), x in zip(more, ids)), key=repr)


def test_language_id(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.language_id(docs)
    held = found.where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
    odd = langid.language_id(spark.createDataFrame(
        [(1, "the 12", "en"), (2, None, "en"), (3, "12 !", None), (4, "the", None)], "doc_id long, text string, lang string"))
    got = {x.doc_id: (x.lang_pred, x.score) for x in odd.collect()}
    assert got[2] == got[3] == ("und", 0.0) and got[4][0] == "en" and 0 <= got[4][1] <= 1


def test_cross_parsing_counts_longest_matches():
    sample = {"a": "abcabcab", "b": "xyzzyxyz"}
    parser = langid.CrossParser(sample)
    for text in ("abcabxyz", "zzyxabq", "cab" * 300):
        for j, lang in enumerate(parser.langs):
            want = 0
            for lo in range(0, len(text), langid.BLOCK):
                block, at = text[lo:lo + langid.BLOCK], 0
                while at < len(block):
                    n = 1
                    while at + n < len(block) and block[at:at + n + 1] in sample[lang]:
                        n += 1
                    at += n
                    want += 1
            assert abs(int(parser.phrases([text])[0, j]) - want) <= 1 + text.count("q") + len(text) // langid.BLOCK


def test_secret_scan(spark):
    import base64
    import json
    import re
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    jwt = f"{part({'alg': 'HS256'})}.{part({'sub': '1'})}.c2ln"
    fake = f"{part({'typ': 'x'})}.{part({'sub': '1'})}.c2ln"
    der = bytes([0x30, 0x24, 2, 1, 0, 4, 31]) + bytes(range(31))
    key = base64.b64encode(der).decode()
    texts = [None, "", f"é TOKEN = 'abcdef' token=abc token:token:abcdefg {jwt} {fake}", "AKIA" + "A" * 16 + " AKIAABC",
             f"-----BEGIN PRIVATE KEY-----\n{key}\n-----END PRIVATE KEY----- x", f"k {key} {der.hex()}", "0" * 24 + "g" + "f" * 23,
             "ſecret=abcdefgh paſſword"]
    got = {x.doc_id: x for x in secret_scan.digest(
        frame(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        base = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in re.finditer(
            r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[1]) >= 6]
        base += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        base += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        want = ",".join(x for _, _, x in sorted(base))
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == j for _, k, _ in base) for j in range(3))
    assert got[2].spans.count("signed:") == 1 and "pem:0:" in got[4].spans and "der:" not in got[4].spans
    assert "der:2:" in got[5].spans and "derhex:" in got[5].spans
    clean = [x.text for x in secret_scan.mask(frame(spark, [(1, texts[2], None), (2, None, None)])).orderBy("doc_id").collect()]
    assert jwt not in clean[0] and fake in clean[0] and clean[1] is None


def secret_cases():
    """Texts with one key each, and the kind that is to cover it from its place on."""
    import base64
    import json

    def element(tag, *parts):
        body = b"".join(parts)
        n = len(body)
        return bytes([tag, *([n] if n < 128 else [0x82, n >> 8, n & 255])]) + body

    r = random.Random(5)
    ed = element(0x30, element(2, b"\0"), element(0x30, element(6, b"\x2b\x65\x70")), element(4, element(4, r.randbytes(32))))
    rsa = element(0x30, element(2, b"\0"), *[element(2, b"\1" + b"\xfb\xff" * 4 + r.randbytes(n)) for n in (256, 2, 255, 128, 127)])
    pbes2 = element(0x30, element(0x30, element(6, bytes.fromhex("2a864886f70d01050d")), element(0x30, element(0x30, element(6, bytes.fromhex("2a864886f70d01050c")), element(0x30, element(4, r.randbytes(8)), element(2, b"\x08\0"))),
                element(0x30, element(6, bytes.fromhex("60864801650304012a")), element(4, r.randbytes(16))))),
                    element(4, r.randbytes(160)))
    digest = element(0x30, element(0x30, element(6, bytes.fromhex("608648016503040201")), element(5)), element(4, r.randbytes(32)))
    b64 = lambda x: base64.b64encode(x).decode()
    url = lambda x: base64.urlsafe_b64encode(x).decode().rstrip("=")
    wrap = lambda t, end, n=64: end.join(t[i:i + n] for i in range(0, len(t), n))
    pem = lambda name, body, end: f"-----BEGIN {name}-----{end}{body}{end}-----END {name}-----"
    old = "Proc-Type: 4,ENCRYPTED{0}DEK-Info: AES-128-CBC,{1}{0}{0}".format
    token = lambda h: f"{url(h)}.{url(json.dumps({'sub': '1'}).encode())}.c2ln"
    found = [
        (pem("PRIVATE KEY", b64(ed), "\\n"), "pem"), (pem("RSA PRIVATE KEY", wrap(b64(rsa), "\\n"), "\\n"), "pem"),
        (pem("RSA PRIVATE KEY", wrap(b64(rsa), "\\r\\n"), "\\r\\n"), "pem"),
        (pem("RSA PRIVATE KEY", old("\n", "AB" * 16) + wrap(b64(r.randbytes(608)), "\n"), "\n"), "pem"),
        (pem("RSA PRIVATE KEY", old("\\n", "AB" * 16) + wrap(b64(r.randbytes(608)), "\\n"), "\\n"), "pem"),
        (pem("ENCRYPTED PRIVATE KEY", wrap(b64(pbes2), "\n"), "\n"), "pem"),
        (wrap(b64(rsa), "\n"), "der"), (wrap(b64(rsa), "\r\n  ", 76), "der"), (wrap(b64(rsa), "\\n"), "der"),
        (url(rsa), "der"), (url(ed), "der"), (b64(pbes2), "der"), (rsa.hex().upper(), "derhex"), (wrap(rsa.hex(), "\n"), "derhex"),
        (token(b'{ "alg": "HS256"}'), "signed"), (token(b'{\r\n "alg": "HS256"}'), "signed"), (token(b'\n{"alg": "HS256"}'), "signed")]
    bad = old("\n", "AB" * 16) + b64(r.randbytes(607))
    none = [b64(digest), url(rsa)[:-4], wrap(b64(rsa[:-3]), "\n"), rsa.hex().upper()[:-2], pem("RSA PRIVATE KEY", bad, "\n"),
            pem("ENCRYPTED PRIVATE KEY", b64(r.randbytes(160)), "\n"), token(b'{ "typ": "x"}')]
    return found, none


def test_secret_scan_decodes_every_usual_form():
    found, none = secret_cases()
    for body, kind in found:
        for before, after in (("", ""), ("key: ", " end"), ("words before\n", "\nWords after"), ('{"k": "a\\n', '\\n"}')):
            spans = [x for x in secret_scan.scan(before + body + after) if x[1] >= 3]
            assert spans == [(len(before), secret_scan.KINDS.index(kind), len(before + body))], (body, before)
    for body in none:
        assert not [x for x in secret_scan.scan(f"a {body} z") if x[1] >= 3], body


def test_pii(spark):
    rows = [(1, "Mail Ann.B@Site4.example.org or ann.b@site4.example.org, call +1 (017) 555-7713.", None),
            (2, "+1-017-555-7713 and 4952935900253052, not 9807915762804490; 10.0.0.1 1.2.3.4.5 999.1.1.1", None),
            (3, "Frau Weber and Mr. Otto Klein met Herr Klein. ann.b@site4.example.org", None),
            (4, "clean text, 12 of 345", None), (5, None, None), (None, "ann.b@site4.example.org", None)]
    rows += [(10 + k, f"card {x}", None) for k, x in enumerate(("4111111111111111", "4111 1111 1111 1111"))]
    got = {x.doc_id: x for x in pii.replace_entities(frame(spark, rows), "k").collect()}
    assert got[4].text == rows[3][1] and got[5].text is None
    assert (got[1].n_email, got[1].n_phone, got[2].n_card, got[2].n_ip, got[3].n_name) == (1, 1, 1, 1, 3)
    mails = [got[1].text.split()[1], got[1].text.split()[3][:-1], got[3].text.split()[-1], got[None].text]
    assert len({m.lower() for m in mails}) == 1 and mails[1:] == [mails[1]] * 3 and "ann.b" not in mails[0].lower()
    assert mails[0][0].isupper() and mails[0].endswith(".org") and mails[0].count(".") == 3
    digits = lambda t: "".join(c for c in t if c.isdigit())
    phone1, phone2 = got[1].text.split("call ")[1], got[2].text.split(" and ")[0]
    assert digits(phone1) == digits(phone2) and phone1.startswith("+1 (") and phone2[2] == "-" != phone2[3]
    assert "9807915762804490" in got[2].text and "1.2.3.4.5" in got[2].text and "999.1.1.1" in got[2].text
    card = digits(got[10].text)
    assert card == digits(got[11].text) != "4111111111111111" and len(got[11].text) == len(rows[-1][1])
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(card[::-1]))
    assert total % 10 == 0 and card[0] == "4"
    assert got[3].text.startswith("Frau ") and " Mr. " in got[3].text and "Klein" not in got[3].text
    again = {x.doc_id: x.text for x in pii.replace_entities(frame(spark, rows), "k").collect()}
    other = {x.doc_id: x.text for x in pii.replace_entities(frame(spark, rows), "other").collect()}
    assert again == {i: x.text for i, x in got.items()} and other[2] != again[2]


def test_pii_surrogates_stay_distinct_in_a_crowded_space(spark):
    """All but a few one-digit addresses are taken: candidates collide and are drawn again."""
    own = [(i, f"{a}.{b}.1.1", None) for i, (a, b) in enumerate((a, b) for a in range(1, 10) for b in range(10))]
    got = [x.text for x in pii.replace_entities(frame(spark, own), "k").collect()]
    assert len(set(got)) == len(own) and not set(got) & {t for _, t, _ in own}


def test_minhash(spark, rows):
    own = sorted({(i, t or "") for i, t, _ in rows if i is not None}, key=lambda x: -x[0])
    docs = [(i, t, None) for i, t in own]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def shingles(t):
        w = [x for x in t.translate(lower).replace("\x0b", " ").split()]
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    got = {x.doc_id: x for x in minhash.edited_fingerprints(frame(spark, docs)).collect()}
    error = []
    for k, (i, t) in enumerate(own):
        after = own[(k + 1) % len(own)][1]
        n = len(t) // 3
        edited = t[:len(t) - n] + after[:n]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(t)
        a, b, c = shingles(t), shingles(edited), shingles(after)
        error += [got[i].near_edited - len(a & b) / len(a | b), got[i].near_next - len(a & c) / len(a | c)]
    assert abs(np.mean(error)) < 0.02 and np.mean(np.abs(error)) < 0.04
    same = {}
    for i, t in own:
        assert same.setdefault(t, got[i].fingerprint) == got[i].fingerprint
    alone = minhash.edited_fingerprints(frame(spark, docs[:1])).first()
    assert alone.near_next == 1.0
