"""Operator 6: secret scans with structural confirmation.

Base patterns (assignments, access keys, hex runs) report as they are.  Beyond
them, base64 and hex candidates are decoded and reported only when their
structure confirms a secret: a signed token whose header is JSON with an
``alg``, or a key encoding (DER, also password-encrypted) whose nested lengths
add up at every depth and whose elements are those of a private key, bare or
between PEM lines.  Line ends inside a key may be real or escaped
(backslash and n or r), base64 of either alphabet, hex of either case; a bare key
is read as far as its outer length says and must end there.  A PEM body that its
headers call encrypted has no structure of its own: its headers must name cipher
and vector, and its length must fit the cipher's blocks.  Spans are code points,
end exclusive.

Defined results: null text is empty text (no spans); every row gives one row;
a token whose JSON nests deeper than the parser goes is none; a null id stays null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import bounded, id_text, map_arrow, map_batches, read_table, texts

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a shorter run holds no match at all
HEX = re.compile(r"[0-9a-f]{24,}")
# The first byte of a header is a brace or a JSON blank.
SIGNED = re.compile(r"(?:(?<![A-Za-z0-9_-])|(?<=\\[nrt]))([CDIe][A-Za-z0-9_-]{10,}+)"
                    r"\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]*+)")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----([^-]*+(?:-(?!----)[^-]*+)*+)-----END \1-----")
ENCRYPTED = re.compile(r"Proc-Type:\s*4,\s*ENCRYPTED\s+DEK-Info:\s*([A-Z0-9-]+),\s*([0-9A-Fa-f]+)")
HEADER = re.compile(r"^[ \t]*[A-Za-z][A-Za-z0-9-]*:.*(?:\n[ \t]+\S.*)*", re.M)
_ESCAPED_END = re.compile(r"\\+r\\+n|\\+[nr]|\\(?=[\r\n])|\r\n?")
_LINE_END = r"[ \t]*+(?:(?:\r|\n|\\+[nr]|\\(?=[\r\n]))[ \t]*+)++"
# Where a DER SEQUENCE may begin: 0x30 and a length.
BASE64 = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\[nrt]))(?=(M[A-P][A-Za-z0-9+/_-]{14}))")
DERHEX = re.compile(r"(?<![0-9A-Fa-f])(?=(30[0-9A-Fa-f]{22}))")
_LINE = {16: re.compile(r"[0-9A-Fa-f]++"), 64: re.compile(r"[A-Za-z0-9+/_-]++")}
_END = re.compile(_LINE_END)
#: Least base64 letters of a bare key.
SHORTEST_KEY = 40
# Algorithms of an encrypted key: PKCS 5 and the password-based ones of PKCS 12.
PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
KINDS = ("assign", "access", "hex", "signed", "pem", "der", "derhex")
SHORTEST_VALUE = 6


#: Bytes of a private key on a curve; some writers leave out a leading zero byte.
CURVE_BYTES = {n - less for n in (14, 16, 20, 21, 24, 25, 28, 29, 30, 32, 36, 40, 48, 52, 57, 64, 66, 72)
               for less in (0, 1)}
#: A key's encoding has far fewer elements; bounds the work at one place of a text.
MOST_ELEMENTS = 200
INTEGER, BITS, OCTETS, OID, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30
Element = tuple[int, int, int]  # tag, start and end of the content


class _Der:
    """Elements of an encoding whose bytes are read where they are needed:
    ``read(i, n)`` gives up to n bytes from byte i."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read, self.left = read, MOST_ELEMENTS

    def element(self, at: int, end: int) -> Element | None:
        """The element at ``at``; None where it doesn't fit before ``end``."""
        self.left -= 1
        head = self.read(at, min(6, end - at))
        if len(head) < 2 or self.left < 0:
            return None
        n, start = head[1], at + 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or len(head) < 2 + k:
                return None
            n, start = int.from_bytes(head[2:2 + k], "big"), start + k
        return (head[0], start, start + n) if start + n <= end else None

    def children(self, start: int, end: int) -> list[Element] | None:
        """The elements that fill start to end; None where they don't."""
        out, at = [], start
        while at < end:
            e = self.element(at, end)
            if e is None:
                return None
            out.append(e)
            at = e[2]
        return out

    def well_formed(self, e: Element) -> bool:
        """Whether constructed elements are filled by elements, at every depth, and
        integers and object names have a valid form."""
        todo = [e]
        while todo:
            tag, start, end = todo.pop()
            if tag & 0x20:
                inner = self.children(start, end)
                if inner is None:
                    return False
                todo += inner
            elif tag == INTEGER:
                head = self.read(start, min(2, end - start))
                if not head or len(head) == 2 and (head[0] == 0 and head[1] < 0x80 or head[0] == 0xFF and head[1] >= 0x80):
                    return False
            elif tag == OID and (start == end or self.read(end - 1, 1)[0] & 0x80):
                return False
        return True

    def algorithm(self, e: Element) -> bytes | None:
        """The object name of an algorithm: a SEQUENCE of it and at most its parameters."""
        inner = self.children(e[1], e[2]) if e[0] == SEQUENCE else None
        if not inner or len(inner) > 2 or inner[0][0] != OID:
            return None
        return self.read(inner[0][1], min(inner[0][2] - inner[0][1], 64))

    def wrapped(self, e: Element, tags: tuple[int, ...]) -> bool:
        """Whether one element with one of the tags fills e."""
        inner = self.element(e[1], e[2])
        return inner is not None and inner[2] == e[2] and inner[0] in tags and self.well_formed(inner)

    def is_key(self, size: int) -> bool:
        outer = self.element(0, size)
        if outer is None or outer[0] != SEQUENCE or outer[2] != size:
            return False
        parts = self.children(outer[1], outer[2])
        if not parts:
            return False
        tags = [t for t, _, _ in parts]
        if tags == [SEQUENCE, OCTETS]:  # encrypted
            name = self.algorithm(parts[0])
            return name is not None and name.startswith(PASSWORD_BASED) and parts[1][2] > parts[1][1] \
                and self.well_formed(parts[0])
        if len(parts) < 3 and tags != [INTEGER, OCTETS] or tags[0] != INTEGER or parts[0][2] - parts[0][1] != 1:
            return False
        version = self.read(parts[0][1], 1)[0]
        if version > 1:
            return False
        if tags[1:3] == [SEQUENCE, OCTETS]:  # of any algorithm
            return set(tags[3:]) <= {0xA0, 0x81, 0xA1} and self.algorithm(parts[1]) is not None \
                and all(map(self.well_formed, [parts[1], *parts[3:]])) \
                and self.wrapped(parts[2], (INTEGER, OCTETS, SEQUENCE, 0x80))
        if tags[1] == OCTETS:  # of a curve
            return parts[1][2] - parts[1][1] in CURVE_BYTES and tags[2:] in ([], [0xA0], [0xA1], [0xA0, 0xA1]) \
                and all(self.wrapped(e, (OID, SEQUENCE) if e[0] == 0xA0 else (BITS,)) for e in parts[2:])
        # numbers: RSA (with more than two primes a last SEQUENCE) or DSA
        return tags in ([INTEGER] * 9, [INTEGER] * 9 + [SEQUENCE], [INTEGER] * 6) and all(map(self.well_formed, parts))


def is_key_der(raw: bytes) -> bool:
    """Whether the bytes are one private key: RSA (PKCS 1) or DSA numbers, a curve's
    key (SEC 1), a key with its algorithm (PKCS 8) or an encrypted one, every length
    adding up at every depth."""
    return _Der(lambda i, n: raw[i:i + n]).is_key(len(raw))


def _b64(text: str, urlsafe: bool = False) -> bytes | None:
    body = re.sub(r"\s+", "", text).rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), b"-_" if urlsafe else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    head, body = _b64(header, True), _b64(payload, True)
    try:
        head, body = json.loads(head or b""), json.loads(body or b"")
    except (ValueError, RecursionError):  # no JSON, or nested deeper than the parser goes
        return False
    alg = head.get("alg") if isinstance(head, dict) else None
    return isinstance(alg, str) and isinstance(body, dict) and (bool(signature) or alg.lower() == "none")


def is_pem_key(body: str) -> bool:
    """Whether what stands between PEM lines holds a key."""
    body = _ESCAPED_END.sub("\n", body).replace("\\t", "\t").replace("\\/", "/")
    encrypted = ENCRYPTED.search(body)
    raw = _b64(HEADER.sub("", ENCRYPTED.sub("", body)))
    if not raw:
        return False
    if encrypted:
        vector = len(encrypted[2]) // 2
        return vector in (8, 16) and len(encrypted[2]) % 2 == 0 and len(raw) % vector == 0
    return is_key_der(raw) or raw.startswith(b"openssh-key-v1\0")


class _Run:
    """Letters that follow one another over line ends, from ``at`` on."""

    def __init__(self, text: str, at: int, base: int):
        self.text, self.base, self.start, self.before = text, base, [], [0]
        self.end = at
        while m := _LINE[base].match(text, at):
            self.start.append(at)
            self.before.append(self.before[-1] + m.end() - at)
            self.end = m.end()
            gap = _END.match(text, self.end)
            if not gap:
                break
            at = gap.end()

    def number(self, at: int) -> int:
        """How many letters stand before the place ``at`` in the text."""
        i = bisect_right(self.start, at) - 1
        return self.before[i] + at - self.start[i]

    def letters(self, k: int, n: int) -> str:
        i = bisect_right(self.before, k) - 1
        out = []
        while n > 0 and i < len(self.start):
            skip = k - self.before[i]
            part = self.text[self.start[i] + skip:self.start[i] + min(self.before[i + 1] - self.before[i], skip + n)]
            out.append(part)
            k, n, i = k + len(part), n - len(part), i + 1
        return "".join(out)

    def reader(self, k: int, head: bytes) -> Callable[[int, int], bytes]:
        """Reads bytes of what is encoded from letter k on and begins with ``head``."""
        def read16(i: int, n: int) -> bytes:
            own = self.letters(k + 2 * i, 2 * n)
            return bytes.fromhex(own[:len(own) & ~1])

        def read64(i: int, n: int) -> bytes:
            own = self.letters(k + i // 3 * 4, (n + i % 3 + 2) // 3 * 4).translate(_STANDARD)
            return binascii.a2b_base64(own[:len(own) & ~3] + (own[len(own) & ~3:] + "==")[:4] * (len(own) % 4 > 1))[
                i % 3:i % 3 + n]

        read = read16 if self.base == 16 else read64
        return lambda i, n: head[i:i + n] if i + n <= len(head) else read(i, n)


def _bare_key(run: _Run, at: int, head: bytes) -> int | None:
    """End of the key that begins at ``at`` with the bytes ``head``, maybe over several lines."""
    k = run.number(at)
    der = _Der(run.reader(k, head))
    room = run.before[-1] - k
    outer = der.element(0, room // 2 if run.base == 16 else room * 3 // 4)
    if outer is None:
        return None
    size = outer[2]
    letters = 2 * size if run.base == 16 else (4 * size + 2) // 3
    if run.base == 64 and letters < SHORTEST_KEY or not der.is_key(size):
        return None
    last = bisect_right(run.before, k + letters - 1) - 1
    end = run.start[last] + k + letters - run.before[last]
    rest = run.letters(k + letters, min(1, run.before[last + 1] - k - letters))
    if run.base == 16:
        return None if rest else end
    body = run.letters(k, letters)
    urlsafe = "-" in body or "_" in body
    if rest and (urlsafe or rest not in "-_") or urlsafe and ("+" in body or "/" in body):
        return None
    for _ in range(-letters % 4):
        end += run.text.startswith("=", end)
    return end


def _bare_keys(text: str, start: re.Pattern, base: int, kind: int) -> list[tuple[int, int, int]]:
    """Candidates of one run of lines share its letters, and each reads only where
    lengths stand, so the work grows with the text."""
    out, done, run = [], 0, None
    for m in start.finditer(text):
        if m.start() >= done:
            if run is None or m.start() >= run.end:
                run = _Run(text, m.start(), base)
            head = bytes.fromhex(m[1]) if base == 16 else binascii.a2b_base64(m[1].translate(_STANDARD))
            end = _bare_key(run, m.start(), head)
            if end is not None:
                out.append((m.start(), kind, end))
                done = end
    return out


_STANDARD = str.maketrans("-_", "+/")


def confirmed(text: str) -> list[tuple[int, int, int]]:
    """Spans that only their decoded structure makes a secret."""
    out, at = [], 0
    while m := SIGNED.search(text, at):
        fine = is_signed_token(*m.groups())
        if fine:
            out.append((m.start(), 3, m.end()))
        at = m.end() if fine else m.end(1)
    if "PRIVATE KEY-----" in text:
        out += [(m.start(), 4, m.end()) for m in PEM.finditer(text) if is_pem_key(m[2])]
    inside = [(a, b) for a, k, b in out if k == 4]
    for start, base, kind in ((BASE64, 64, 5), (DERHEX, 16, 6)):
        for x in _bare_keys(text, start, base, kind):
            i = bisect_right(inside, (x[0], len(text))) - 1
            if i < 0 or x[0] >= inside[i][1]:
                out.append(x)
    return out


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, index of kind, end) of all spans, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
           if m.end(2) - m.start(2) >= SHORTEST_VALUE]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    for m in HEX.finditer(text):
        out.append((m.start(), 2, m.end()))
        if m[0].startswith("30") and len(m[0]) % 2 == 0 and is_key_der(bytes.fromhex(m[0])):
            out.append((m.start(), 6, m.end()))
    return sorted(set(out + confirmed(text)))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans: array of (kind, start, end) ordered by start, then kind."""
    def run(batch):
        return {"doc_id": batch.column("doc_id"),
                "spans": [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan(t)]
                          for t in texts(batch)]}

    return map_arrow(id_text(docs, id_col, text_col), run,
                     "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def digest(docs: DataFrame) -> DataFrame:
    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def n(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return secret_spans(docs).select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def mask(docs: DataFrame, marker: str = "[secret]") -> DataFrame:
    """``docs`` with every span of its text replaced; overlapping spans are one."""
    names = docs.columns
    at = names.index("text")

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        out, done = [], 0
        for a, _, b in scan(text):
            if b <= done:
                continue
            if a >= done:
                out += [text[done:a], marker]
            done = b
        return "".join(out) + text[done:]

    def run(batches):
        for batch in bounded(batches):
            own = pa.array(map(clean, batch.column(at).to_pylist()), pa.string())
            yield batch.set_column(at, batch.schema.field(at), own)

    return map_batches(docs, run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    return digest(read_table(spark, sf_dir, "documents"))
