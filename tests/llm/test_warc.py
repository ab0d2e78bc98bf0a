"""WARC round trips against brute force, with splits that cut headers, blocks and
line ends, and payloads that look like records."""
import gzip
import hashlib
import random
import re

import pytest

from milepost.llm import warc

SCHEMA = "page_id long, url string, html string, size string, path string, head string, block string, strong string"
FAKE = ("WARC/1.1\r\nWARC-Type: response\r\nPage-Id: 99\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
        "WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n")


def rows(n=60, seed=3):
    r = random.Random(seed)
    html = ["x" * 1200, "a\r\nb" * 300, "é" * 700, "", None, FAKE * 12, "\r\n\r\nWARC/1.1\r\n", "line: x\r\n" * 150,
            "<p>" + "w " * 40 + "</p>\n" * 9]
    out = [(i, [None, f"http://h/{i} \n", "http://ü/"][i % 3], r.choice(html) if i % 4 else f"{i} " + "y" * r.randint(0, 1500))
           for i in range(n)]
    return out + [(None, None, None), (None, "u", "x" * 1200), (7, "u", "z" * 2000), (7, "u", "z" * 2000), (3, "v", FAKE)]


def frame(spark, data, parts=2):
    return spark.createDataFrame([(*x, *["c"] * 5) for x in data], SCHEMA).repartition(parts)


def expected(data, least=warc.LEAST):
    body = [(i, (h or "").encode()) for i, _, h in data]
    top = {}
    for i, b in body:
        if len(b) >= least and i is not None:
            top[b] = max(top.get(b, i), i)
    out = []
    for i, b in body:
        other = top.get(b) if top.get(b) != i else None
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if other is not None else "response", other))
    return sorted(out, key=repr)


@pytest.fixture()
def split_size(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}

    def put(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], "1b")
    yield put
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", ["128m", "3000b", "170b"])
def test_round_trip(spark, split_size, size):
    data = rows(60 if size != "170b" else 16)
    split_size(size)
    got = warc.round_trip(frame(spark, data))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(data)


def test_empty_table(spark):
    assert warc.round_trip(frame(spark, [])).collect() == []


def test_hot_payload(spark):
    data = [(i, "u", "same " * 300) for i in range(700)] + [(i, "u", f"{i} " * 300) for i in range(700, 800)]
    assert sorted(map(tuple, warc.round_trip(frame(spark, data, 5)).collect()), key=repr) == expected(data)


def parse(raw):
    """The records of a whole file, one after the other."""
    at, out = 0, []
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at) + 4
        n = int(re.search(rb"Content-Length: (\d+)\r\n\r\n$", raw[at:end]).group(1))
        assert raw[end + n:end + n + 4] == b"\r\n\r\n"
        out.append((at, raw[at:end], raw[end:end + n]))
        at = end + n + 4
    return out


def test_files_are_warc_records(spark, tmp_path):
    warc.write_archives(frame(spark, rows()), str(tmp_path / "w"))
    records = [x for f in (tmp_path / "w").glob("part-*") for x in parse(f.read_bytes())]
    assert len(records) == len(rows())
    assert all(h.startswith(b"WARC/1.1\r\nWARC-Type: re") and b"\r\nWARC-Record-ID: <urn:uuid:" in h for _, h, _ in records)
    assert not any(b" " in u or b"\n" in u for _, h, _ in records for u in re.findall(rb"Target-URI: (.*?)\r\n", h))


def foreign():
    """Records of another writer: other header case, folded lines, no HTTP, binary."""
    binary = bytes(range(256)) * 9
    records = []
    for kind, extra, block in [
            (b"warcinfo", b"", b"software: x\r\n"), (b"resource", b"Content-Type: image/png\r\n", binary),
            (b"resource", b"X-Long: a\r\n  folded\r\n", FAKE.encode()), (b"metadata", b"", b""),
            (b"response", b"content-type: application/http; msgtype=response\r\n",
             "HTTP/1.1 200 Ä\r\nA: é\r\n\r\n".encode() + binary)] * 3:
        records.append(b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\n" + extra +
                       b"content-length:  %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")
    return records


@pytest.mark.parametrize("size", ["128m", "400b"])
@pytest.mark.parametrize("most_splits", [warc.SPLITS, 0])
def test_foreign_archives(spark, tmp_path, split_size, size, most_splits):
    records = foreign()
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    cut = b"".join(records)[:-30]  # the last block is cut off
    (tmp_path / "c.warc").write_bytes(cut)
    (tmp_path / "d.warc").write_bytes(b"no archive\n" + records[0])
    split_size(size)
    got = warc.read_archives(spark, str(tmp_path), most_splits).collect()
    for name, n in [("a.warc", 15), ("b.warc.gz", 15), ("c.warc", 14), ("d.warc", 0)]:
        own = sorted((x for x in got if x.path.endswith("/" + name)), key=lambda x: x.offset)
        want, at = [], 0
        for r in records[:n]:
            head, block = r.split(b"\r\n\r\n", 1)
            block = block[:-4]
            want.append((at, block, block.split(b"\r\n\r\n", 1)[1] if b"application/http" in head else block))
            at += len(r)
        assert [(x.offset, bytes(x.block), bytes(x.payload)) for x in own] == want
        if n > 2:
            assert own[2].headers["x-long"] == "a folded" and own[1].headers["content-type"] == "image/png"


def test_broken_chain_stops(spark, tmp_path):
    records = foreign()
    (tmp_path / "a.warc").write_bytes(records[0] + records[1][:-4] + b"junk" + b"".join(records[2:]))
    (tmp_path / "b.warc").write_bytes(records[0] + records[1] + b"junk\r\n" + b"".join(records[2:]))
    got = warc.read_archives(spark, str(tmp_path)).collect()
    count = {n: sum(x.path.endswith(n) for x in got) for n in ("a.warc", "b.warc")}
    assert count == {"a.warc": 15, "b.warc": 2}  # what closes a block is not looked at, where it ends is
