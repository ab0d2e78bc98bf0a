"""Inputs that broke an operator once: colliding words, dense groups of near copies,
deep and long structures."""
import base64
import json
import random
import time

import numpy as np
import pytest

from milepost.llm import anchors, pii, secret_scan, simhash, substring_fm
from milepost.llm.wordhash import span_hashes, spans


def doubling_words(n):
    """Two words that every polynomial hash modulo 2**64 with an odd base confuses."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [16, 64, 1024, 4096])
def test_word_hashes_of_doubling_words(n):
    both = " ".join(doubling_words(n)).encode()
    flat = np.frombuffer(both, np.uint8)
    first, second = span_hashes(flat, *spans(flat != 32)).tolist()
    assert first != second and first & 0xFFFFFFFFFFFF != second & 0xFFFFFFFFFFFF


def test_substring_dedup_of_doubling_words(spark):
    head = " ".join(f"w{i}" for i in range(49))
    x, y = doubling_words(1024)
    docs = spark.createDataFrame([(1, f"{head} {x}"), (2, f"{head} {y}"), (3, f"{head} {x}")], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_fm.deduplicated(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 50}


@pytest.mark.parametrize("run_bytes", [6, 8])
def test_runs_that_agree_in_32_bits_are_several(run_bytes):
    class Rows:
        h = np.array([5, 5, 9, 9, 7], np.uint64)
        run = np.array([1 << 40 | 3, 1 << 41 | 3, 4, 4, 6], np.uint64)
        doc = np.arange(5)

    class Ids:
        ids = np.arange(5)

    key, shared, run, _ = anchors.first_keys(Rows, Ids, run_bytes)
    entry = np.concatenate([anchors.low_bytes((key & anchors.LOW39) | np.where(shared, anchors.FLAG, np.uint64(0))), run], axis=1)
    assert list(anchors.shared_anchors([entry.tobytes()], run_bytes)[0]) == [2, 0, 1]
    # the same in two chunks that hold one run each
    entries = [np.concatenate([anchors.low_bytes(np.array([5], np.uint64)), anchors.low_bytes(np.array([r], np.uint64), run_bytes)],
                              axis=1).tobytes() for r in (1 << 40 | 3, 1 << 41 | 3)]
    assert [list(x) for x in anchors.shared_anchors(entries, run_bytes)] == [[2], [2]]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def labels(fps, distance):
    """Smallest (signed) fingerprint reachable, by flooding."""
    a = np.array(sorted(fps, key=signed), np.uint64)
    out = {}
    for first in a.tolist():
        todo = [first] if first not in out else []
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = first
                todo += a[np.bitwise_count(a ^ np.uint64(x)) <= distance].tolist()
    return out


def near_copies(n, seed=3):
    r = random.Random(seed)
    words = [f"w{r.getrandbits(30)}" for _ in range(120)]
    texts = set()
    while len(texts) < n:
        own = list(words)
        own[r.randrange(len(own))] = f"x{r.getrandbits(20)}"
        texts.add(" ".join(own))
    return {simhash.fingerprint(t.encode()) for t in texts}


@pytest.mark.parametrize("most", [simhash.GROUP, 40])
def test_dense_near_copies(spark, most):
    from milepost.llm.components import components
    fps = near_copies(3000 if most == simhash.GROUP else 600)
    distinct = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = components(simhash.links(distinct, most=most)).collect()
    label = {x.node % (1 << 64): x.label % (1 << 64) for x in found}
    assert {f: label.get(f, f) for f in fps} == labels(fps, 4)


def test_rows_per_fingerprint_stay_bounded():
    """However dense the copies: a fingerprint goes to one group per set of bytes."""
    masks = simhash.first_masks(4)
    assert len(masks) == 70 and all(m.bit_count() == 32 for m in masks)
    r = random.Random(1)
    for _ in range(2000):  # partners meet in one, and in one of the finer ones again
        a = r.getrandbits(64)
        b = a ^ sum(1 << k for k in r.sample(range(64), r.randint(1, 4)))
        level = [m for m in masks if not (a ^ b) & m]
        assert level
        while level and (finer := simhash.finer_masks(level[0], 4)):
            assert len(finer) == 5
            level = [m for m in finer if not (a ^ b) & m]
            assert level


def test_star_links_in_parts(monkeypatch):
    fps = np.array(sorted(near_copies(400)), np.uint64)
    whole = simhash.star_links(fps, 4)
    monkeypatch.setattr(simhash, "VARIANTS", 5000)
    assert sorted(map(tuple, simhash.star_links(fps, 4).tolist())) == sorted(map(tuple, whole.tolist()))


def b64(raw):
    return base64.b64encode(raw).decode()


def token(head, body):
    return ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (head, body, b"sig"))


def test_deeply_nested_token_is_no_crash(spark):
    for body in (b"[" * 200_000, b'{"a":' * 100_000, b'{"a":' + b"[" * 100_000 + b"]" * 100_000 + b"}"):
        text = token(b'{"alg":"HS256"}', body)
        assert secret_scan.scan(text) == []
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        assert secret_scan.mask(docs).first().text == text


def test_der_like_lines_take_linear_time():
    r = random.Random(2)
    lines = []
    for _ in range(78_000):
        head = [b"\x30\x82" + r.randbytes(2) + b"\x02\x01\0\x30\x0d\x06\x09", b"\x30\x83\x05" + r.randbytes(2) + b"\x02\x01\0\x02\x82\x01"]
        raw = r.choice(head)
        lines.append(b64(raw + r.randbytes(48 - len(raw))))
    text = "\n".join(lines)
    assert len(text) > 5_000_000
    began = time.process_time()
    assert not [x for x in secret_scan.scan(text) if x[1] >= 3]
    assert time.process_time() - began < 5


def element(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    return bytes([tag, *([n] if n < 128 else [0x82, n >> 8, n & 255])]) + body


def keys():
    r = random.Random(7)
    number = lambda n: element(2, b"\x01" + r.randbytes(n))
    zero, one, curve = element(2, b"\0"), element(2, b"\1"), element(6, bytes.fromhex("2a8648ce3d030107"))
    rsa = element(0x30, zero, *[number(n) for n in (255, 2, 255, 127, 127, 127, 127, 127)])
    dsa = element(0x30, zero, *[number(n) for n in (127, 19, 127, 127, 19)])
    sec1 = element(0x30, one, element(4, r.randbytes(32)), element(0xA0, curve), element(0xA1, element(3, b"\0\4" + r.randbytes(64))))
    rsa8 = element(0x30, zero, element(0x30, element(6, bytes.fromhex("2a864886f70d010101")), element(5)), element(4, rsa))
    ec8 = element(0x30, zero, element(0x30, element(6, bytes.fromhex("2a8648ce3d0201")), curve), element(4, sec1))
    ed = element(0x30, one, element(0x30, element(6, b"\x2b\x65\x70")), element(4, element(4, r.randbytes(32))), element(0x81, b"\0" + r.randbytes(32)))
    return [rsa, dsa, sec1, rsa8, ec8, ed]


def test_key_structures():
    for raw in keys():
        assert secret_scan.is_key_der(raw)
        text = f"x {b64(raw)} y"
        assert [x for x in secret_scan.scan(text) if x[1] == 5] == [(2, 5, len(text) - 2)]
        assert not secret_scan.is_key_der(raw[:-1]) and not secret_scan.is_key_der(raw + b"\0")


def test_other_structures_are_no_keys():
    r = random.Random(8)
    zero, one, name = element(2, b"\0"), element(2, b"\1"), element(6, bytes.fromhex("2a864886f70d010101"))
    pdu = element(0xA0, element(2, b"\x12\x34"), zero, zero, element(0x30, element(0x30, element(6, b"\x2b\6\1\2\1\1\1\0"), element(5))))
    others = [
        element(0x30, zero, element(4, b"public"), pdu), element(0x30, one, element(4, r.randbytes(32)), pdu),  # SNMP
        bytes.fromhex("30220201 00301D".replace(" ", "")) + b"\xff" * 29,
        element(0x30, zero, element(0x30, r.randbytes(12)), element(4, element(4, r.randbytes(32)))),
        element(0x30, zero, element(0x30, name, element(5)), element(4, r.randbytes(40))),
        element(0x30, zero, *[element(2, b"\1" + r.randbytes(9))] * 4), element(0x30, zero, *[element(2, b"\0\1")] * 8),
        element(0x30, element(2, b"\5"), *[element(2, b"\1" + r.randbytes(9))] * 8),
        element(0x30, *[element(2, b"\1")] * 500)]
    for raw in others:
        assert not secret_scan.is_key_der(raw), raw.hex()
        assert not [x for x in secret_scan.scan(f"a {b64(raw)} b {raw.hex().upper()} c") if x[1] >= 3]


def test_token_payload_must_be_an_object():
    assert secret_scan.scan(token(b'{"alg":"HS256"}', json.dumps({"sub": "1"}).encode()))[0][1] == 3
    assert secret_scan.scan(token(b'{"alg":"HS256"}', b"[1]")) == []


def test_more_names_than_short_surrogates(spark, monkeypatch):
    """Two syllables make 16 family names of four; 60 people need longer ones."""
    monkeypatch.setattr(pii, "SYLLABLES", {k: v[:2] for k, v in pii.SYLLABLES.items()})
    names = ["".join(random.Random(i).choices("abcdefgh", k=7)).capitalize() for i in range(60)]
    docs = spark.createDataFrame([(i, f"Herr {n} kam, Frau {n} ging") for i, n in enumerate(names)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.replace_entities(docs, "k").collect()}
    men = {t.split()[1] for t in got.values()}
    women = {t.split()[4] for t in got.values()}
    assert len(men) == len(women) == 60 and not (men | women) & set(names) and not men & women


@pytest.mark.parametrize("kind, canon, attempts", [("phone", "0175557713", 17), ("card", "4111111111111111", 17), ("ip", "1.2.3.4", 70)])
def test_late_surrogates_get_longer(spark, kind, canon, attempts):
    rows = spark.createDataFrame([(kind, canon, a) for a in (0, attempts, attempts + 8)], "kind string, canon string, attempt int")
    short, late, later = [r.s for r in rows.select("attempt", pii.surrogate("k").alias("s")).orderBy("attempt").collect()]
    assert len(short) == len(canon) < len(late) < len(later) or kind == "ip" and ":" in late and len(later) > len(late.split(":")[0]) + 1


def test_forms_of_a_phone_number_are_one_entity(spark):
    forms = ["+1 (017) 555-7713", "(017) 555-7713", "017-555-7713", "+49 017 555 7713"]
    docs = spark.createDataFrame([(i, f"call {f} now") for i, f in enumerate(forms)] + [(9, "no 1017-555-7713 or 017-555-77134 or 5-017-555-7713")],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in pii.replace_entities(docs, "k").collect()}
    numbers = ["".join(c for c in got[i].text if c.isdigit()) for i in range(4)]
    assert len({n[-10:] for n in numbers}) == 1 and numbers[0][-10:] != "0175557713"
    assert [n[:-10] for n in numbers] == ["1", "", "", "49"] and got[2].text[8] == got[2].text[12] == "-"
    assert all(got[i].n_phone == 1 for i in range(4)) and got[9].n_phone == 0
