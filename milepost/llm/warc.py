"""Operator 11: WARC archives, written and read back with boundary-chain verification.

Writing: one record a page.  The payload (HTTP body) is the html; of records with
equal payloads of at least ``least`` bytes the one with the largest id carries it
(response), the others refer to it (revisit).  Spark's text writer puts the
records one after the other: the separator that ends a record is its line end.

Reading: the archives are scanned as lines, in splits of any size, so a large file
is read by many tasks.  A line that begins with the magic may begin a record or
may be payload.  Each task gives, for every such candidate whose header parses,
where its successor must begin, followed to the end of the split.  Pointer jumping
over these ends, from the start of each file, in rounds that double the distance,
keeps what the chain of records reaches; magic inside a payload is reached by none.
A second scan follows the chain from each split's entry and takes the blocks.  What
crosses a split (headers or blocks) comes in parts that are put together.

A line's offset: every line belongs to the split it begins in (a split that begins
inside a line leaves it to the one before), so a split's first line begins where
the lines of the splits before it end - a running sum over one row per split.

Skew: a payload that a third of the pages share costs partial sums; its pages find
the chosen one by (payload, salt).  Broadcast, each counted first: the chosen ones, up
to ``BROADCAST_ROWS`` (beyond it pages are dealt by payload and salt); a row per split
of the archives, up to ``SPLITS`` (beyond it lines are dealt to the splits).

Defined results: null html is an empty payload; a null id is written without one
and read as null, and is chosen only where no row of the payload has an id; rows
that share the largest id of their payload are each a response; blanks and control
characters of a url are percent-encoded, a null url is an empty one; other columns
are ignored; an empty table gives no rows.  A record whose block is cut off by the
file's end is not returned, nor is what follows a record whose successor is no
record.  Archives may be compressed as a whole or record by record (.gz), then a
file is one split.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from milepost.llm.common import checkpointed, map_batches, read_table
from milepost.session import ensure_checkpoint_dir, remove_folder

LEAST = 1000  # bytes from which equal payloads are kept once
SALTS = 32
BROADCAST_ROWS = 50_000  # of some 80 bytes
SPLITS = 1_000_000
END = 4  # a record ends with two line ends
MAGIC = "WARC/1."
_LINE = re.compile(rb"(?:[!-9;-~]+:|[ \t])[^\n]*\r\n")
_START = re.compile(rb"WARC/1\.[0-9]\r\n")
_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r$")
_SQL_LENGTH = r"(?imd)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r$"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# writing

def _uri(url: Column) -> Column:
    """The url without line ends, other control characters and blanks."""
    coded = F.aggregate(F.concat(F.sequence(F.lit(0), F.lit(32)), F.array(F.lit(127))), url,
                        lambda u, c: F.replace(u, F.char(c), F.concat(F.lit("%"), F.lpad(F.hex(c), 2, "0"))))
    return F.coalesce(F.when(url.rlike(r"[\x00-\x20\x7F]"), coded).otherwise(url), F.lit(""))


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.coalesce(page.cast("string"), F.lit("none")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"),
                    F.lit(">"))


def with_original(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html and, for a payload kept in another record, that record's
    page (``original``)."""
    own = pages.withColumn("size", F.octet_length("html").cast("long")) \
        .withColumn("strong", F.when(F.col("size") >= least, F.sha2(F.col("html").cast("binary"), 256))) \
        .withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    part = own.where("strong IS NOT NULL").groupBy("strong", "salt").agg(
        F.max("page_id").alias("top"), F.count("*").alias("n"))
    many = part.groupBy("strong").agg(F.max("top").alias("top"), F.sum("n").alias("n"),
                                      F.collect_set("salt").alias("salts")) \
        .where("n > 1 AND top IS NOT NULL").select("strong", F.explode("salts").alias("salt"), "top")
    many = checkpointed(many)
    if many.count() <= BROADCAST_ROWS:  # the payloads stay where they are
        many = F.broadcast(many)
    return own.join(many, ["strong", "salt"], "left").select(
        "page_id", "url", "html", "size", F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")).alias("original"))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            least: int = LEAST, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """record: the text of each page's record, without the line ends that close it."""
    own = with_original(pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("html")), least)
    digest = F.sha1(F.col("html").cast("binary"))
    revisit = F.col("original").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit("\r\n\r\n"))
    lines = [
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _record_id(F.col("page_id"), F.col("digest")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), _uri(F.col("url")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), _record_id(F.col("original"), F.col("digest")),
                                 F.lit(f"\r\nWARC-Profile: {PROFILE}"))).otherwise(""),
        F.when(F.col("page_id").isNotNull(), F.concat(F.lit("\r\nPage-Id: "), F.col("page_id").cast("string")))
        .otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"), F.lit("\r\n\r\n"), F.col("block")]
    return own.withColumn("digest", digest) \
        .withColumn("block", F.concat(http, F.when(revisit, "").otherwise(F.col("html")))) \
        .select(F.concat(*lines).alias("record"))


def write_archives(pages: DataFrame, folder: str, **options) -> None:
    records(pages, **options).write.option("lineSep", "\r\n\r\n").text(folder)


# reading

def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of the archives with their bytes, in order within each split; the
    path comes with lines that begin with the magic only."""
    text = spark.read.option("lineSep", "\n").text(folder)
    return text.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.when(F.startswith("value", F.lit(MAGIC)), F.col("_metadata.file_path")).alias("path"),
        F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("line"))


def _pieces(batches):
    """For each piece of a batch that lies in one split: its first row's values,
    where its lines begin, its bytes, and the rows that hold the magic."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        line, path = batch.column("line"), batch.column("path")
        wide = pa.types.is_large_binary(line.type)
        off = np.frombuffer(line.buffers()[1], np.int64 if wide else np.int32)[line.offset:line.offset + batch.num_rows + 1]
        raw = memoryview(line.buffers()[2])
        magic = np.flatnonzero(path.is_valid().to_numpy(zero_copy_only=False))
        key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "split")])
        cut = np.r_[0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, batch.num_rows]
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            own = magic[(magic >= a) & (magic < b)]
            yield ({c: batch.column(c)[a].as_py() for c in batch.schema.names if c not in ("line", "path")},
                   (off[a:b + 1] - off[a]).astype(np.int64), bytes(raw[off[a]:off[b]]), own - a,
                   path[int(own[0])].as_py() if len(own) else None)


def _header_end(raw: bytes, at: int) -> tuple[int, bool]:
    """Where the header lines from ``at`` end, and whether that is settled: an empty
    line (then its end) or a line of another kind (then -1) was met."""
    while at < len(raw):
        if raw[at:at + 2] == b"\r\n":
            return at + 2, True
        m = _LINE.match(raw, at)
        if not m:
            return -1, True
        at = m.end()
    return at, False


def _length(header: bytes) -> int:
    m = _LENGTH.search(header)
    return int(m.group(1)) if m else -1


class _Split:
    """Candidates of one split, offsets counted from its first line."""

    def __init__(self, key: dict):
        self.key, self.size, self.path = key, 0, None
        self.found: list[tuple[int, int, int]] = []  # start, block, length
        self.open, self.open_at = None, 0  # header not yet ended
        self.head, self.head_open = b"", key["split"] > 0  # lines that may end the header of the split before

    def add(self, begin: np.ndarray, raw: bytes, magic: np.ndarray, path: str | None) -> None:
        self.path = self.path or path
        if self.head_open:
            end, settled = _header_end(raw, 0)
            self.head += raw[:max(end, 0)]
            self.head_open = not settled
            if settled and end < 0:
                self.head = b""
        if self.open is not None:
            end, settled = _header_end(raw, 0)
            self._settle(self.open + raw[:max(end, 0)], self.open_at, end, settled)
        for i in magic.tolist():
            at = int(begin[i])
            first = _START.match(raw, at)
            if first:
                end, settled = _header_end(raw, first.end())
                self._settle(raw[at:max(end, 0)], self.size + at, end, settled)
        self.size += len(raw)

    def _settle(self, header: bytes, at: int, end: int, settled: bool) -> None:
        self.open = None
        if not settled:
            self.open, self.open_at = header, at
        elif end >= 0 and (n := _length(header)) >= 0:
            self.found.append((at, at + len(header), n))

    def rows(self) -> list[tuple]:
        """(file, split, path, size, head, head_open, tail, start, block, end, exit,
        last_start, last_block, last_end): the split, then its candidates."""
        own = (self.key["file"], self.key["split"], self.path)
        out = [(*own, self.size, self.head, self.head_open, self.open, self.open_at if self.open is not None else None,
                *[None] * 6)]
        chain: dict[int, tuple] = {}
        for at, block, n in reversed(self.found):
            end = block + n
            chain[at] = chain.get(end + END, (end + END, at, block, end))
            out.append((*own, None, None, None, None, at, block, end, *chain[at]))
        return out


_SCAN = ("file long, split long, path string, size long, head binary, head_open boolean, tail binary, start long, "
         "block long, end long, exit long, last_start long, last_block long, last_end long")


def _scan(lines: DataFrame) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_SCAN))

    def given(split):
        columns = list(zip(*split.rows()))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches):
        split = None
        for key, begin, raw, magic, path in _pieces(batches):
            if split is None or split.key != key:
                if split:
                    yield given(split)
                split = _Split(key)
            split.add(begin, raw, magic, path)
        if split:
            yield given(split)

    return map_batches(lines, run, _SCAN)


def _nodes(scan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits (file, split, base) and candidates with offsets from the file's start;
    a header that goes on in the splits after its own is put together here."""
    order = W.partitionBy("file").orderBy("split")
    splits = checkpointed(scan.where("size IS NOT NULL").withColumn(
        "base", F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn(
        "until", F.min(F.when(~F.col("head_open"), F.col("split"))).over(order.rowsBetween(1, W.unboundedFollowing))))
    shift = [(F.col(c) + F.col("base")).alias(c) for c in
             ("start", "block", "end", "exit", "last_start", "last_block", "last_end")]
    inside = scan.where("size IS NULL").join(splits.select("file", "split", "base"), ["file", "split"]) \
        .select("file", "split", "path", F.lit(None).cast("binary").alias("header"), *shift)
    heads = splits.select(F.col("file").alias("f"), F.col("split").alias("s"), F.col("head").alias("more"))
    tails = splits.where("tail IS NOT NULL").join(
        heads, (F.col("file") == F.col("f")) & (F.col("s") > F.col("split")) & (F.col("s") <= F.col("until"))) \
        .groupBy("file", "split").agg(
            F.first("path").alias("path"), F.first("tail").alias("tail"), F.first("base").alias("base"),
            F.first("start").alias("start"), F.sort_array(F.collect_list(F.struct("s", "more"))).alias("heads")) \
        .withColumn("header", F.aggregate("heads", F.col("tail"), lambda a, h: F.concat(a, h["more"]))) \
        .withColumn("text", F.col("header").cast("string")) \
        .where(F.endswith("text", F.lit("\r\n\r\n")) & F.col("text").rlike(_SQL_LENGTH)) \
        .withColumn("start", F.col("base") + F.col("start")) \
        .withColumn("block", F.col("start") + F.octet_length("header")) \
        .withColumn("end", F.col("block") + F.regexp_extract("text", _SQL_LENGTH, 1).try_cast("long")) \
        .select("file", "split", "path", "header", "start", "block", "end", (F.col("end") + END).alias("exit"),
                F.col("start").alias("last_start"), F.col("block").alias("last_block"), F.col("end").alias("last_end"))
    return splits.select("file", "split", "base"), inside.unionByName(tails)


def _reached(nodes: DataFrame) -> DataFrame:
    """The candidates where the chain from a file's start enters a split."""
    node, to = ["file", "start"], nodes.select("file", F.col("exit").alias("start")).distinct()
    entries = checkpointed(nodes.where("start = 0").unionByName(
        nodes.where("start > 0").join(to, node, "left_semi")))
    seen = entries.where("start = 0").select(*node)
    jump = entries.select("file", "start", F.col("exit").alias("to"))
    n = seen.count()
    while True:
        step = seen.join(jump, node).select("file", F.col("to").alias("start")).join(
            entries.select(*node), node, "left_semi")
        seen = checkpointed(seen.unionByName(step).distinct())
        if (now := seen.count()) == n:
            return entries.join(seen, node, "left_semi")
        n = now
        far = jump.select(F.col("file").alias("f"), F.col("start").alias("to_start"), F.col("to").alias("far"))
        jump = checkpointed(jump.join(far, (F.col("file") == F.col("f")) & (F.col("to") == F.col("to_start")))
                            .select("file", "start", F.col("far").alias("to")))


def _guides(splits: DataFrame, reached: DataFrame) -> DataFrame:
    """For each split its base, the entry of the chain, and the record that covers
    its first byte (open_*), if any."""
    entry = reached.groupBy("file", "split").agg(F.min("start").alias("entry"))
    last = reached.select(F.col("file").alias("f"), F.col("last_start").alias("open_start"),
                          F.col("last_block").alias("open_block"), F.col("last_end").alias("open_end"),
                          F.col("exit").alias("open_exit"))
    return splits.join(entry, ["file", "split"], "left").join(
        last, (F.col("file") == F.col("f")) & (F.col("base") > F.col("open_start")) & (F.col("base") < F.col("open_exit")),
        "left").drop("f", "open_exit")


class _Follower:
    """Takes the blocks of the chain's records out of one split's bytes."""

    def __init__(self, g: dict):
        if g["base"] is None:
            raise RuntimeError("the splits of the archives changed between the two scans; read them again")
        self.g, self.at, self.want, self.left, self.path = g, g["base"], g["entry"], b"", None
        self.now = None  # start, block, end, header (None: begun in an earlier split), path, parts
        if g["open_start"] is not None:
            self.now = (g["open_start"], g["open_block"], g["open_end"], None, None, [])

    def add(self, raw: bytes, path: str | None):
        raw, self.left, self.path = self.left + raw, b"", self.path or path
        lo, hi = self.at, self.at + len(raw)
        self.at = hi
        while True:
            if self.now:
                start, block, end, header, _, parts = self.now
                a, b = max(block, lo), min(end, hi)
                if a < b:
                    parts.append((a, raw[a - lo:b - lo]))
                if end > hi:
                    return
                yield self._part()
                if header is not None:
                    self.want = end + END
                self.now = None
            if self.want is None or self.want >= hi:
                return
            at = self.want - lo
            first = _START.match(raw, at)
            end, settled = _header_end(raw, first.end()) if first else (-1, True)
            if not settled:
                self.left, self.at = raw[at:], self.want
                return
            if end < 0 or (n := _length(raw[at:end])) < 0:
                self.want = None
                return
            self.now = (self.want, lo + end, lo + end + n, raw[at:end], self.path, [])

    def _part(self) -> tuple:
        start, block, end, header, path, parts = self.now
        data = b"".join(p for _, p in parts)
        # a record whose header and whole block lie here is complete
        return (self.g["file"], path, start, header, parts[0][0] if parts else block, data, end - block,
                header is not None and len(data) == end - block)

    def rest(self):
        if self.now and (self.now[5] or self.now[3] is not None):
            yield self._part()


_PART = "file long, path string, start long, header binary, at long, data binary, length long, whole boolean"


def _parts(lines: DataFrame) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_PART))

    def given(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        split = None
        for key, _, raw, _, path in _pieces(batches):
            if split is None or (split.g["file"], split.g["split"]) != (key["file"], key["split"]):
                if split and (rows := list(split.rest())):
                    yield given(rows)
                split = _Follower(key)
            if rows := list(split.add(raw, path)):
                yield given(rows)
        if split and (rows := list(split.rest())):
            yield given(rows)

    return map_batches(lines, run, _PART)


def _whole_records(parts: DataFrame, tails: DataFrame) -> DataFrame:
    """path, start, header, block of every record, parts of a record put together."""
    columns = ["file", "path", "start", "header", "at", "data", "length"]
    open_ = parts.where("NOT whole").select(*columns).unionByName(tails.select(
        "file", "path", "start", "header", F.col("block").alias("at"), F.lit(b"").alias("data"),
        (F.col("end") - F.col("block")).alias("length")))
    put = open_.groupBy("file", "start").agg(
        F.max("path").alias("path"), F.max("header").alias("header"), F.max("length").alias("length"),
        F.sort_array(F.collect_list(F.struct("at", "data"))).alias("parts")) \
        .withColumn("block", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["data"]))) \
        .where("octet_length(block) = length")
    return parts.where("whole").select("path", "start", "header", F.col("data").alias("block")).unionByName(
        put.select("path", "start", "header", "block"))


def read_archives(spark: SparkSession, folder: str, most_splits: int = SPLITS) -> DataFrame:
    """path, offset, headers (map, names in lower case), block and payload (what
    follows the HTTP header of an application/http block, else the block) of every
    record that the chain from its file's start reaches."""
    lines = _lines(spark, folder)
    scan = checkpointed(_scan(lines))
    splits, nodes = _nodes(scan)
    reached = checkpointed(_reached(nodes))
    guides = checkpointed(_guides(splits, reached))
    if guides.count() <= most_splits:
        guided = lines.join(F.broadcast(guides), ["file", "split"], "left")
    else:  # the lines are dealt to their splits, in their order
        guided = lines.withColumn("place", F.monotonically_increasing_id()).join(
            guides.hint("merge"), ["file", "split"], "left") \
            .repartition("file", "split").sortWithinPartitions("file", "split", "place").drop("place")
    found = _whole_records(_parts(guided), reached.where("header IS NOT NULL"))
    text = F.col("header").cast("string")
    unfolded = F.regexp_replace(text, r"\r\n[ \t]+", " ")
    fields = F.filter(F.split(unfolded, "\r\n"), lambda x: F.instr(x, ":") > 0)
    headers = F.map_from_entries(F.aggregate(
        F.transform(fields, lambda x: F.struct(F.lower(F.substring_index(x, ":", 1)).alias("key"),
                                               F.trim(F.substr(x, F.instr(x, ":") + F.lit(1))).alias("value"))),
        F.array().cast("array<struct<key:string,value:string>>"),
        lambda a, x: F.when(F.exists(a, lambda y: y["key"] == x["key"]), a).otherwise(F.concat(a, F.array(x)))))
    http = F.startswith(F.lower(F.coalesce(F.col("headers")["content-type"], F.lit(""))), F.lit("application/http"))
    before = F.substring_index(F.col("block").cast("string"), "\r\n\r\n", 1)
    payload = F.when(http & (F.octet_length(before) < F.octet_length("block")),
                     F.substr(F.col("block"), F.octet_length(before) + F.lit(5))).otherwise(F.col("block"))
    return found.withColumn("headers", headers).select("path", F.col("start").alias("offset"), "headers", "block",
                                                       payload.alias("payload"))


def resolved(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; a revisit's
    payload is that of the record it refers to (null where that is not there)."""
    h = F.col("headers")
    own = checkpointed(found.select(
        h["page-id"].cast("long").alias("page_id"), h["warc-type"].alias("record_type"),
        h["warc-record-id"].alias("record_id"), h["warc-refers-to"].alias("target"),
        F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("digest"))
        .withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")))
    revisits = own.where("record_type = 'revisit'")
    targets = revisits.select("target", "salt").distinct().join(
        own.where("record_type = 'response'").groupBy(F.col("record_id").alias("target")).agg(
            F.max("page_id").alias("refers_to"), F.max("size").alias("payload_bytes"),
            F.max("digest").alias("payload_digest")), "target")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return own.where("record_type <> 'revisit'").select(
        "page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.join(targets, ["target", "salt"], "left").select(*out))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Pages written as archives and read back; the archives are removed."""
    spark = pages.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, **options)
    out = checkpointed(resolved(read_archives(spark, folder)))
    remove_folder(spark, folder)
    return out


def query(spark, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "pages"))


SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, octet_length(encode(coalesce(html, ''))) AS size
           FROM pages),
top AS (SELECT body, max(page_id) AS original FROM p WHERE size >= {LEAST} GROUP BY body)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN original IS NULL OR original IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END
       AS record_type,
       CASE WHEN original IS DISTINCT FROM page_id THEN original END AS refers_to
FROM p LEFT JOIN top ON size >= {LEAST} AND p.body = top.body
"""
