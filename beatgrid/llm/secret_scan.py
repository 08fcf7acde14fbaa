"""Secrets in texts: pattern matches, and keys and signed tokens confirmed by their structure.

Three patterns find what looks like a secret: an assignment to a telling name, an access
key name, a long hexadecimal run. Beside them, every candidate that could be an encoded
key is decoded and parsed, and is a finding only if the whole of it holds together:

``pem``
    an armoured private key: its base64 body decodes to a key as below, or is an
    encrypted body behind the customary headers
``key``
    a base64 or hexadecimal run that decodes to a private key: nested type, length and
    value fields that fill each other exactly and have the layout of a PKCS#8 (plain or
    encrypted), RSA or elliptic-curve key, or the length-prefixed fields of an OpenSSH key
``token``
    three base64url fields joined by dots: a JSON header that names a signature
    algorithm, a JSON object, and a signature of the length that this algorithm has

Public keys, certificates, unsigned tokens and random base64 are no findings.

Candidates are found by one linear pass each; decoding and parsing look at every byte of
a candidate a bounded number of times (``DEPTH`` levels of nesting).

Defined cases: an absent or empty text has no findings; offsets count code points, ends
are exclusive; findings of one kind never overlap, those of two kinds may; texts are read
whole, however long; repeated rows are scanned each; an empty table gives no rows; other
columns, whatever their names, stay as they are in ``row``.
"""

import base64
import binascii
import json
import re
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import map_batches

# The three patterns, and what each match must hold to stay.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "key", "token")

# Signature bytes by algorithm; RSA signatures are as long as their modulus.
SIGNATURE_BYTES = {
    "HS256": (32,), "HS384": (48,), "HS512": (64,),
    "ES256": (64,), "ES256K": (64,), "ES384": (96,), "ES512": (132,), "EdDSA": (64, 114),
    "RS256": (128, 256, 384, 512), "RS384": (128, 256, 384, 512), "RS512": (128, 256, 384, 512),
    "PS256": (128, 256, 384, 512), "PS384": (128, 256, 384, 512), "PS512": (128, 256, 384, 512),
}

LEAST_RUN, DEPTH = 40, 12
RUNS = tuple(re.compile(r"[A-Za-z0-9%s]{%d,}={0,2}" % (marks, LEAST_RUN)) for marks in ("+/", "_-"))
FIRST = "Mb36"  # how base64 and hex of a sequence field or of the OpenSSH mark begin
HEX_RUN = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
DOTTED = re.compile(r"[A-Za-z0-9_.-]{%d,}" % LEAST_RUN)
ARMOUR = re.compile(r"-----(BEGIN|END) ((?:[A-Z0-9]+ ){0,3}PRIVATE KEY)-----")
SPACE = re.compile(r"\s+|\\n|\\r")
HEADERS = re.compile(r"(?:Proc-Type|DEK-Info|Comment):[^\n]*")

INTEGER, OCTETS, OBJECT, SEQUENCE, CONTEXT_0 = 0x02, 0x04, 0x06, 0x30, 0xA0
OPENSSH = b"openssh-key-v1\0"


# --- nested type, length, value ---------------------------------------------------

def fields(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """``(type, start, end)`` of the values that fill the range exactly, or None."""
    found, at = [], start
    while at < end:
        if at + 2 > end:
            return None
        kind, length, at = data[at], data[at + 1], at + 2
        if length >= 0x80:
            width = length & 0x7F
            if not 1 <= width <= 4 or at + width > end:
                return None
            length, at = int.from_bytes(data[at:at + width], "big"), at + width
            if length < 0x80 or length >> 8 * (width - 1) == 0:
                return None  # a shorter form exists
        if at + length > end:
            return None
        found.append((kind, at, at + length))
        at += length
    return found


def well_nested(data: bytes, start: int, end: int, depth: int = DEPTH) -> bool:
    """Whether fields fill the range and so do those inside each constructed field."""
    inside = fields(data, start, end) if depth else None
    return inside is not None and all(well_nested(data, a, b, depth - 1) for kind, a, b in inside if kind & 0x20)


def number(data: bytes, field: tuple[int, int, int]) -> int | None:
    kind, start, end = field
    return int.from_bytes(data[start:end], "big") if kind == INTEGER and 0 < end - start else None


def names_algorithm(data: bytes, field: tuple[int, int, int]) -> bool:
    inner = fields(data, field[1], field[2]) if field[0] == SEQUENCE else None
    return bool(inner) and inner[0][0] == OBJECT and inner[0][2] - inner[0][1] >= 3


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are one PKCS#8, RSA or elliptic-curve private key and nothing else."""
    whole = fields(data, 0, len(data)) if data[:1] == b"\x30" else None
    if not whole or len(whole) != 1 or not well_nested(data, 0, len(data)):
        return False
    inner = fields(data, *whole[0][1:])
    kinds = [f[0] for f in inner]
    if len(inner) < 2:
        return False
    if kinds == [SEQUENCE, OCTETS]:  # encrypted PKCS#8
        return names_algorithm(data, inner[0]) and inner[1][2] - inner[1][1] >= 16
    version = number(data, inner[0])
    if version in (0, 1) and kinds[1:3] == [SEQUENCE, OCTETS]:
        return names_algorithm(data, inner[1]) and inner[2][2] - inner[2][1] >= 16
    if version in (0, 1) and kinds[:9] == [INTEGER] * 9:
        modulus, parts = number(data, inner[1]), [number(data, f) for f in inner[4:6]]
        return None not in parts and parts[0] * parts[1] == modulus
    if version == 1 and kinds[1] == OCTETS:
        return 16 <= inner[1][2] - inner[1][1] <= 80 and all(k & 0xE0 == CONTEXT_0 for k in kinds[2:]) and len(kinds) > 2
    return False


def prefixed(data: bytes, at: int) -> tuple[bytes, int] | None:
    """One field behind its four length bytes, and where it ends."""
    if at + 4 > len(data):
        return None
    end = at + 4 + int.from_bytes(data[at:at + 4], "big")
    return (data[at + 4:end], end) if end <= len(data) else None


def is_openssh_key(data: bytes) -> bool:
    """Whether cipher, derivation, keys and the private part are fields that fill the bytes exactly."""
    if not data.startswith(OPENSSH):
        return False
    at, read = len(OPENSSH), []
    for _ in range(3):
        if (field := prefixed(data, at)) is None:
            return False
        read.append(field[0])
        at = field[1]
    count, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    if not read[0] or not 1 <= count <= 16:
        return False
    for _ in range(count + 1):
        if (field := prefixed(data, at)) is None or not field[0]:
            return False
        at = field[1]
    return at == len(data)


def is_key(data: bytes) -> bool:
    return is_der_key(data) or is_openssh_key(data)


# --- encodings ----------------------------------------------------------------------

def from_base64(text: str) -> bytes | None:
    """Bytes of a base64 or base64url run with or without padding; None if its length or alphabet is off."""
    bare = text.rstrip("=")
    if len(bare) % 4 == 1 or (("+" in bare or "/" in bare) and ("-" in bare or "_" in bare)):
        return None
    try:
        return base64.b64decode(bare.replace("-", "+").replace("_", "/") + "=" * (-len(bare) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def from_hex(text: str) -> bytes | None:
    return bytes.fromhex(text) if len(text) % 2 == 0 and HEX_RUN.fullmatch(text) else None


def json_object(text: str) -> dict | None:
    data = from_base64(text)
    if data is None or data[:1] != b"{":
        return None
    try:
        value = json.loads(data)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(text: str) -> bool:
    if not text.startswith("e") or text.count(".") != 2:
        return False
    parts = text.split(".")
    header = json_object(parts[0])
    lengths = SIGNATURE_BYTES.get(header.get("alg")) if header and isinstance(header.get("alg"), str) else None
    signature = from_base64(parts[2]) if lengths and json_object(parts[1]) is not None else None
    return signature is not None and len(signature) in lengths


# --- findings -------------------------------------------------------------------------

def base_findings(text: str) -> Iterator[tuple[str, int, int]]:
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= LEAST_ASSIGN:
            yield "assign", m.start(), m.end()
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= LEAST_ACCESS:
            yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


def armoured(text: str) -> Iterator[tuple[str, int, int]]:
    """Bodies between an opening mark and the very next one, if that closes it."""
    for opening, closing in pairwise(ARMOUR.finditer(text)):
        if (opening.group(1), closing.group(1)) == ("BEGIN", "END") and opening.group(2) == closing.group(2):
            body = text[opening.end():closing.start()]
            data = from_base64(SPACE.sub("", HEADERS.sub("", body)))
            if data and (is_key(data) or ("DEK-Info:" in body and len(data) >= 64 and len(data) % 8 == 0)):
                yield "pem", opening.start(), closing.end()


def bare_keys(text: str) -> Iterator[tuple[str, int, int]]:
    places = set()
    for runs in RUNS:
        for m in runs.finditer(text):
            run = m.group()
            if run[0] in FIRST:
                data = from_hex(run) if HEX_RUN.fullmatch(run) else from_base64(run)
                if data and is_key(data):
                    places.add(m.span())
    end = 0
    for a, b in sorted(places):
        if a >= end:
            yield "key", a, b
            end = b


def signed_tokens(text: str) -> Iterator[tuple[str, int, int]]:
    for m in DOTTED.finditer(text):
        run = m.group().strip(".")
        if is_signed_token(run):
            start = m.start() + m.group().index(run)
            yield "token", start, start + len(run)


def findings(text: str | None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by start, then by kind as listed."""
    found = [*base_findings(text), *armoured(text), *bare_keys(text), *signed_tokens(text)] if text else []
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns but the text in ``row``, with ``findings``: an array of kind, start and end."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"), F.col(text).alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batches):
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end"), f)) for f in findings(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["row", "findings"])

    return map_batches(packed, work, f"row {packed.schema['row'].dataType.simpleString()}, "
                                     "findings array<struct<kind: string, start: long, end: long>>")


def joined(found: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.array_join(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def number_of(kind: str) -> Column:
    return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")


def op11_secret_spans(docs: DataFrame) -> DataFrame:
    """Counts of the pattern matches, a digest of their places, and the places of all findings."""
    scanned = scan(docs)
    base = F.filter("findings", lambda f: f["kind"].isin(*BASE_KINDS))
    counts = [number_of(k).alias(f"n_{k}") for k in BASE_KINDS]
    return scanned.select("row.doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                          joined(F.col("findings")).alias("spans"))
