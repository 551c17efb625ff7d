"""Secret scan with structural confirmation.

Three textual kinds are found by pattern (assignments, access keys, hex runs). On top
of them, encoded candidates are *decoded and parsed* before anything is reported:

``jwt``      three base64url segments whose header is a JSON object naming ``alg`` (signed-token
             header) and whose claims decode to a JSON object.
``der_key``  base64 or hex that decodes to one DER value filling the buffer exactly, whose nested
             lengths all close and whose layout is that of a private key (PKCS#1, PKCS#8, SEC1).
``ssh_key``  base64 of ``openssh-key-v1`` whose length-prefixed fields nest up to a key blob.
``pem``      a PRIVATE KEY armour block whose body decodes to one of the two above (not given again as such).
``basic``    ``Basic`` credentials whose base64 decodes to ``user:password`` in printable ASCII.

Base64 may be of either alphabet and wrapped over lines, with real or written-out (``\\n``) breaks; where a key
begins is told by its first bytes, where it ends by its lengths, and no letter may follow directly.

Defined cases: a null or empty text has no spans and the digest of the empty string;
repeated rows give repeated results; a null doc_id stays null; extra columns are ignored;
an empty table gives an empty result. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common

KINDS = ("assign", "access", "hex", "jwt", "der_key", "ssh_key", "pem", "basic")
RANK = {k: i for i, k in enumerate(KINDS)}

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
JWT = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]{16,}")
DER_START = re.compile(r"M[A-P][A-Za-z0-9+/_-]{10}")  # DER SEQUENCE (0x30) and its length
OPENSSH_START = re.compile(r"b3BlbnNzaC1rZXktdjEA")
#: Line breaks within base64, real or written out, and the backslash that JSON may put before a slash.
BREAK = r"[\x20\t]*(?:\\+[nr]|\\?[\r\n])(?:\\+[nrt]|\s)*|\\(?=/)"
LETTERS = re.compile(r"([A-Za-z0-9+/_-]+)|" + BREAK)
END = re.compile(r"={0,2}(?![A-Za-z0-9+/_=])")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,24}?)PRIVATE KEY-----((?:[A-Za-z0-9+/=\s]|\\+[nrt]|\\(?=[/\s])){40,})-----END \1PRIVATE KEY-----")
WRITTEN_OUT = re.compile(r"\\+[nrt]|\\")
#: Object identifier of RSA keys, 1.2.840.113549.1.1.1.
RSA = bytes.fromhex("2a864886f70d010101")
BASIC = re.compile(r"\bBasic ([A-Za-z0-9+/]{8,}={0,2})(?![A-Za-z0-9+/=])", re.A)
HEX_SEQUENCE = re.compile(r"(?<![0-9a-fA-F])30[0-9a-fA-F]{94,}")

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_structural long"
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_structural", pa.int64())]
)


def decode64(text: str) -> bytes | None:
    """Base64 or base64url bytes, padding optional; None when not well formed."""
    raw = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    if len(raw) % 4 == 1:
        return None
    try:
        return base64.b64decode(raw + "=" * (-len(raw) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, from, to) of the DER values that tile data[start:end] exactly, else None."""
    items = []
    while start < end:
        if end - start < 2:
            return None
        tag, length, at = data[start], data[start + 1], start + 2
        if length & 0x80:
            width = length & 0x7F
            if not 1 <= width <= 4 or at + width > end:
                return None
            length, at = int.from_bytes(data[at : at + width]), at + width
        if at + length > end:
            return None
        items.append((tag, at, at + length))
        start = at + length
    return items


def is_der_key(data: bytes) -> bool:
    """Is it one private key in DER: every nested length closes and the layout fits."""
    outer = der_items(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = der_items(data, *outer[0][1:])
    if not inner or inner[0][0] != 0x02 or inner[0][2] - inner[0][1] != 1:
        return False
    tags = [t for t, _, _ in inner]
    if len(tags) >= 9 and all(t == 0x02 for t in tags[:9]) and all(t in (0x02, 0x30) for t in tags):  # PKCS#1: version and eight integers
        return True
    if len(tags) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:  # PKCS#8: version, algorithm, key octets
        algorithm, key = der_items(data, *inner[1][1:]), der_items(data, *inner[2][1:])
        if not algorithm or algorithm[0][0] != 0x06 or not key or len(key) != 1:
            return False
        # the key octets hold one value: a sequence whose parts close (RSA: a PKCS#1 key), octets or an integer
        rsa = data[algorithm[0][1] : algorithm[0][2]] == RSA
        return is_der_key(data[inner[2][1] : inner[2][2]]) if rsa else key[0][0] in (0x02, 0x04) or key[0][0] == 0x30 and bool(der_items(data, *key[0][1:]))
    return len(tags) >= 2 and tags[1] == 0x04 and data[inner[0][1]] == 1 and inner[1][2] - inner[1][1] >= 16  # SEC1


def is_openssh_key(data: bytes) -> bool:
    """magic, cipher, kdf, kdf options, number of keys, public blob, private blob; all lengths close."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False

    def field(at: int) -> tuple[bytes, int] | None:
        if at + 4 > len(data):
            return None
        n = int.from_bytes(data[at : at + 4])
        return (data[at + 4 : at + 4 + n], at + 4 + n) if at + 4 + n <= len(data) else None

    at = len(magic)
    for _ in range(3):
        if (got := field(at)) is None:
            return False
        at = got[1]
    keys, at = int.from_bytes(data[at : at + 4]), at + 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys + 1):
        if (got := field(at)) is None or not got[0]:
            return False
        at = got[1]
    return at == len(data)


def der_size(data: bytes) -> int | None:
    """Bytes of the DER value that begins here, if it begins as a private key does: a sequence, a version of one byte."""
    width = data[1] & 0x7F if data[1] & 0x80 else 0
    if data[0] != 0x30 or width > 4 or data[1] == 0x80 or data[2 + width : 4 + width] != b"\x02\x01":
        return None
    return 2 + width + (int.from_bytes(data[2 : 2 + width]) if width else data[1])


def letters(text: str, at: int, n: int) -> tuple[str, int] | None:
    """(n letters of base64 from a place on, past line breaks; where they end), None when there are fewer."""
    found: list[str] = []
    while n and (m := LETTERS.match(text, at)):
        if m[1]:
            found.append(m[1][:n])
            n -= len(found[-1])
            at += len(found[-1])
        else:
            at = m.end()
    return None if n else ("".join(found), at)


def read64(text: str, at: int, size: int) -> tuple[bytes, int] | None:
    """(bytes encoded from a place on, where their letters end)."""
    n = -(-size * 4 // 3)
    got = letters(text, at, n) if size and n <= len(text) - at else None
    return got and ((decode64(got[0]) or b"")[:size], got[1])


def openssh_size(text: str, at: int) -> int | None:
    """Bytes of the OpenSSH key that is encoded from a place on, by the lengths of its fields."""

    def number(place: int) -> int | None:
        got = read64(text, at, place + 4)
        return got and int.from_bytes(got[0][place:])

    size, fields = len(b"openssh-key-v1\0"), 3
    for step in range(2):
        for _ in range(fields):
            if (n := number(size)) is None:
                return None
            size += 4 + n
        if step == 0:
            if not 1 <= (keys := number(size) or 0) <= 16:
                return None
            size, fields = size + 4, keys + 1
    return size


def encoded_keys(text: str) -> Iterator[tuple[int, int, str]]:
    """Keys in base64, wherever one begins; what lies within a key is not looked at again."""
    done = 0
    starts = [(m.start(), "der_key") for m in DER_START.finditer(text)]
    if "b3BlbnNzaC1r" in text:
        starts = sorted(starts + [(m.start(), "ssh_key") for m in OPENSSH_START.finditer(text)])
    for at, kind in starts:
        if at < done:
            continue
        size = der_size(decode64(text[at : at + 12])) if kind == "der_key" else openssh_size(text, at)
        if size and (got := read64(text, at, size)) and (end := END.match(text, got[1])) and key_kind(got[0]) == kind:
            done = end.end()
            yield at, done, kind


def is_token(text: str) -> bool:
    """A signed token: header object with ``alg``, claims object, signature bytes."""
    parts = [decode64(x) for x in text.split(".")]
    if len(parts) != 3 or None in parts:
        return False
    try:
        header, claims = json.loads(parts[0]), json.loads(parts[1])
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(claims, dict)


def is_basic(text: str) -> bool:
    data = decode64(text)
    return bool(data) and b":" in data[1:-1] and all(32 < c < 127 for c in data)


def key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "der_key" if is_der_key(data) else "ssh_key" if is_openssh_key(data) else None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the three textual kinds, leftmost and not overlapping within a kind."""
    spans = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return spans


def structural_spans(text: str) -> list[tuple[int, int, str]]:
    """Candidates that survive decoding and parsing."""
    spans, armoured = [], []
    if "eyJ" in text or "." in text and "ey" in text:
        spans += [(m.start(), m.end(), "jwt") for m in JWT.finditer(text) if is_token(m[0])]
    if "-----BEGIN" in text:
        armoured = [(m.start(), m.end(), "pem") for m in PEM.finditer(text) if key_kind(decode64(WRITTEN_OUT.sub("", m[2])))]
        spans += armoured
    spans += [k for k in encoded_keys(text) if not any(a <= k[0] < b for a, b, _ in armoured)]
    for m in HEX_SEQUENCE.finditer(text):
        if len(m[0]) % 2 == 0 and key_kind(bytes.fromhex(m[0])) == "der_key":
            spans.append((m.start(), m.end(), "der_key"))
    if "Basic " in text:
        spans += [(m.start(), m.end(), "basic") for m in BASIC.finditer(text) if is_basic(m[1])]
    return spans


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], RANK[s[2]], s[1])))


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span (overlapping ones merged) replaced by ``[SECRET]``."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its secret spans (see the module for the kinds)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.rows(batches):
            out: dict[str, list] = {f.name: [] for f in ARROW}
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                base = base_spans(value)
                more = structural_spans(value)
                kinds = [k for _, _, k in base]
                out["doc_id"].append(key)
                for k in KINDS[:3]:
                    out[f"n_{k}"].append(kinds.count(k))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(base + more))
                out["n_structural"].append(len(more))
            yield common.batch_of(ARROW, **out)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.utf8(text).alias("text")).mapInArrow(run, SCHEMA)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents, all columns kept, with secrets replaced; null texts stay null, an empty table stays empty."""

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: t if not isinstance(t, str) else redacted(t, s) if (s := base_spans(t) + structural_spans(t)) else t)

    return docs.withColumn(text, clean(F.col(text)))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))
