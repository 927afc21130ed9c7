"""Secret scans with structural confirmation.

Base patterns report credentials by their shape. On top, candidates are decoded and only
reported when their structure holds: base64 or hex text whose bytes are a DER private key with
nested lengths that fill their parents exactly (plain or encrypted under a password scheme), an OpenSSH key with consistent length-prefixed
fields, a PEM block around either, and signed tokens whose header and payload parse as JSON
objects and whose header names an algorithm. A key may be wrapped over lines, or begin inside a
longer run of base64 characters, where its own outer length ends it. Base spans are never changed by the confirmed ones.

Defined results: null and empty texts have no spans; spans are code points, end exclusive,
ordered by start and then kind; repeated rows are scanned one by one; an empty table gives no
row; columns that clash with result names are replaced.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edpanel.llm.common import slices, tuned

KINDS = ("assign", "access", "hex", "pem", "der", "openssh", "jwt")
BASE_KINDS = KINDS[:3]
# Fixed patterns of the base kinds; letters in "assign" match in either case (ASCII only).
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
ASSIGN_VALUE = 6
KEY_CHARS = 1 << 17  # the longest key looked for inside a run

_PEM = re.compile(rb"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")
# Tried at the start of a run of token characters only, so a long run is read once.
_JWT = re.compile(rb"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+(eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+)")
_BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{40,}={0,2}")
# Consecutive lines, from the start of a run only and without backtracking, so a long run is read once.
_WRAPPED = re.compile(rb"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}+(?:\r?\n[ \t]*[A-Za-z0-9+/]{4,}+)++={0,2}")
_INSIDE = re.compile(rb"M(?=[A-P][A-Za-z0-9+/]{2})|b(?=3BlbnNzaC1rZXktdjEA)")  # encoded starts of a SEQUENCE, or of the OpenSSH magic
_SCHEMES = (bytes.fromhex("06092a864886f70d0105"), bytes.fromhex("060a2a864886f70d010c01"))  # password-based encryption
_HEX_ANY = re.compile(rb"[0-9A-Fa-f]{64,}")
_OPENSSH = b"openssh-key-v1\0"
SPANS = "array<struct<kind:string,start:long,end:long>>"


def _decode64(data: bytes, url: bool = False) -> bytes | None:
    data = re.sub(rb"[\s=]", b"", data)
    if url or b"-" in data or b"_" in data:
        data = data.replace(b"-", b"+").replace(b"_", b"/")
    try:
        return base64.b64decode(data + b"=" * (-len(data) % 4), validate=True)
    except binascii.Error:
        return None


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, content start and content end of the DER element at ``at``, inside ``end``."""
    if at + 2 > end:
        return None
    size, body = data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or body + n > end:
            return None
        size, body = int.from_bytes(data[body:body + n], "big"), body + n
    return (data[at], body, body + size) if body + size <= end else None


def der_private_key(data: bytes) -> bool:
    """Whether the bytes are one SEQUENCE whose children fill it exactly and which starts with a
    small version INTEGER followed by key numbers, an algorithm or a private OCTET STRING."""
    top = _tlv(data, 0, len(data))
    if not top or top[0] != 0x30 or top[2] != len(data):
        return False
    at, tags, version = top[1], [], None
    while at < top[2]:
        child = _tlv(data, at, top[2])
        if not child:
            return False
        if not tags and child[0] == 0x02 and child[2] - child[1] == 1:
            version = data[child[1]]
        if child[0] & 0x20:  # constructed: nested lengths must fill it too
            inner = child[1]
            while inner < child[2]:
                element = _tlv(data, inner, child[2])
                if not element:
                    return False
                inner = element[2]
        tags.append(child[0])
        at = child[2]
    if version is None or version > 3 or len(tags) < 3:
        if tags == [0x30, 0x04]:
            return any(data[_tlv(data, top[1], top[2])[1]:].startswith(x) for x in _SCHEMES)
        return len(tags) >= 2 and version == 1 and tags[1] == 0x04
    return tags[:9] == [0x02] * 9 or tags[:3] == [0x02, 0x30, 0x04] or tags[:2] == [0x02, 0x04] or tags == [0x02] * 6


def openssh_key(data: bytes) -> bool:
    """Whether the bytes are an OpenSSH key: magic, cipher, kdf, options, count, public keys and
    the private part, each with a length that fits, ending with the data."""
    if not data.startswith(_OPENSSH):
        return False
    at, left = len(_OPENSSH), 3
    while left or at < len(data):
        if not left:
            if at + 4 > len(data):
                return False
            left, at = int.from_bytes(data[at:at + 4], "big") + 1, at + 4  # public keys, then the private part
            if not 1 < left < 100:
                return False
            for _ in range(left):
                if at + 4 > len(data):
                    return False
                at += 4 + int.from_bytes(data[at:at + 4], "big")
            return at == len(data)
        if at + 4 > len(data):
            return False
        at, left = at + 4 + int.from_bytes(data[at:at + 4], "big"), left - 1
    return False


def signed_token(data: bytes) -> bool:
    """Whether header and payload are JSON objects and the header names an algorithm."""
    header, payload, _ = data.split(b".")
    try:
        parts = [json.loads(_decode64(p, url=True) or b"") for p in (header, payload)]
    except (ValueError, RecursionError):
        return False
    return all(isinstance(p, dict) for p in parts) and isinstance(parts[0].get("alg"), str)


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "der" if der_private_key(data) else "openssh" if openssh_key(data) else None


def _embedded(run: bytes) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of keys that begin inside a run of base64 characters. A DER key ends
    where its outer length says, so only as much is decoded."""
    for m in _INSIDE.finditer(run, 1):
        at = m.start()
        head = _decode64(run[at:at + 8]) or b""
        if head[:1] == b"o":
            if len(run) - at <= KEY_CHARS and openssh_key(_decode64(run[at:]) or b""):
                yield at, len(run), "openssh"
            continue
        wide = head[1] & 0x7F if len(head) > 1 and head[1] & 0x80 else 0
        if head[:1] != b"0" or len(head) < 2 + wide or wide > 2:
            continue
        size = 2 + wide + (int.from_bytes(head[2:2 + wide], "big") if wide else head[1])
        chars = -(-size * 4 // 3)
        if size >= 30 and chars <= len(run) - at:
            decoded = _decode64(run[at:at + chars + -chars % 4].rstrip(b"="))
            if decoded and der_private_key(decoded[:size]):
                yield at, at + chars, "der"


def find(data: bytes) -> list[tuple[int, int, int]]:
    """(byte start, kind number, byte end) of all spans of one UTF-8 text, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(data) if len(m[2]) >= ASSIGN_VALUE]
    if b"AKIA" in data:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(data)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(data)]
    if b"PRIVATE KEY-----" in data:
        out += [(m.start(), 3, m.end()) for m in _PEM.finditer(data) if _key_kind(_decode64(m[2]))]
    for m in _BASE64.finditer(data):
        decoded = _decode64(m[0])
        kind = _key_kind(decoded) if decoded and decoded[:1] in (b"0", b"o") else None
        if kind:
            out.append((m.start(), KINDS.index(kind), m.end()))
        else:
            out += [(m.start() + a, KINDS.index(k), m.start() + b) for a, b, k in _embedded(m[0])]
    for m in _WRAPPED.finditer(data):
        kind = _key_kind(_decode64(m[0]))
        if kind:
            out.append((m.start(), KINDS.index(kind), m.end()))
    for m in _HEX_ANY.finditer(data):
        kind = _key_kind(binascii.unhexlify(m[0])) if len(m[0]) % 2 == 0 and m[0][:2].lower() in (b"30", b"6f") else None
        if kind:
            out.append((m.start(), KINDS.index(kind), m.end()))
    if b"eyJ" in data:
        out += [(m.start(1), 6, m.end()) for m in _JWT.finditer(data) if signed_token(m[1])]
    return sorted(set(out))


def scan(df: DataFrame) -> DataFrame:
    """``df`` with ``spans``: all spans of ``text`` (kind, start, end)."""
    tuned(df.sparkSession)
    df = df.drop("spans").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*df.schema.fields, T.StructField("spans", T._parse_datatype_string(SPANS))])
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def spans(text: str | None) -> list[dict]:
        data = (text or "").encode()
        found = find(data)
        if not found:
            return []
        if len(data) == len(text):
            return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found]
        out, at, seen = [], 0, 0
        for s, k, e in found:  # starts ascend: count code points once along the text
            seen, at = seen + len(data[at:s].decode()), s
            out.append({"kind": KINDS[k], "start": seen, "end": seen + len(data[s:e].decode())})
        return out

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = pa.array([spans(t) for t in batch.column("text").to_pylist()], kind_type)
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "spans"])

    return df.mapInArrow(task, schema)


def spans_of(*kinds: str) -> F.Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def span_list(kinds: tuple[str, ...] = KINDS) -> F.Column:
    """``kind:start:end`` of the spans of these kinds, comma-joined in their order."""
    return F.array_join(F.transform(spans_of(*kinds), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted_text(text: str, mark: str) -> str:
    """``text`` with every run of overlapping or touching spans replaced by ``mark``."""
    data = text.encode()
    out, at = [], None
    for start, _, end in find(data):
        if at is None or start > at:
            out += [data[at or 0:start], mark.encode()]
        at = end if at is None else max(at, end)
    return text if at is None else b"".join([*out, data[at:]]).decode()


def redact(df: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every run of overlapping or touching spans in ``text`` replaced by ``mark``."""
    tuned(df.sparkSession)
    df = df.withColumn("text", F.col("text").cast("string"))
    place = df.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = pa.array([t and redacted_text(t, mark) for t in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if k == place else c for k, c in enumerate(batch.columns)], batch.schema.names)

    return df.mapInArrow(task, df.schema)
