"""Secrets in text: patterns, and encoded keys and tokens confirmed by their structure.

A run of base64 or hex is reported as a key only after it has been decoded and its parts
hold together: every length in it, nested ones included, must fit, and the fields must be
those of a private key. A signed token must have a header that names its algorithm.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch
from .features import utf8

# The kinds of spans in the order that breaks ties.
KINDS = ["assign", "access", "hex", "jwt", "pem", "der", "ssh"]
BASE_KINDS = 3
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
JWT = re.compile(r"(?<![A-Za-z0-9_-])ey[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*){2,4}")
PEM_BEGIN, PEM_END = (re.compile(rf"-----{side} ([A-Z0-9 ]*PRIVATE KEY)-----") for side in ("BEGIN", "END"))
ESCAPED_END = re.compile(r"\\+[nrt]")
JOINT = re.compile(r"""["']\s*\+?\s*["']""")
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
DER_START = re.compile(r"M[CDEFGHI][0-9A-Za-z]")
HINTS = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
SHORTEST_RUN = 32

Span = tuple[int, int, int]  # start, end, kind


def decoded(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, with or without its padding."""
    plain = text.rstrip("=").translate(str.maketrans("-_", "+/"))
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


# ---- key encodings ---------------------------------------------------------------


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, first byte of the content, byte after it) of the element at ``at``, if its length fits."""
    if at + 2 > end:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length >= 0x80:
        size = length & 0x7F
        if not 1 <= size <= 4 or at + size > end or data[at] == 0:
            return None
        length, at = int.from_bytes(data[at : at + size], "big"), at + size
        if length < 0x80:  # the short form was due
            return None
    return (tag, at, at + length) if at + length <= end else None


def children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill a content exactly, else None."""
    found = []
    while at < end:
        one = element(data, at, end)
        if one is None:
            return None
        found.append(one)
        at = one[2]
    return found


SEQUENCE, INTEGER, OCTETS, OBJECT = 0x30, 0x02, 0x04, 0x06


def private_key_length(data: bytes) -> int:
    """Bytes of the DER private key that ``data`` starts with, 0 if it starts with none.

    Known are RSA and DSA keys (a version and five or more integers), elliptic curve keys
    (version 1, octets), PKCS#8 (version, algorithm, octets) and encrypted PKCS#8 (algorithm
    with parameters, octets).
    """
    whole = element(data, 0, len(data))
    if not whole or whole[0] != SEQUENCE:
        return 0
    parts = children(data, whole[1], whole[2])
    if not parts or len(parts) < 2:
        return 0
    tags = [tag for tag, _, _ in parts]

    def algorithm(part: tuple[int, int, int]) -> bool:
        inner = children(data, part[1], part[2]) if part[0] == SEQUENCE else None
        return bool(inner) and inner[0][0] == OBJECT and inner[0][2] - inner[0][1] >= 3

    version = data[parts[0][1]] if tags[0] == INTEGER and parts[0][2] - parts[0][1] == 1 else None
    good = (
        (version == 0 and len(parts) >= 6 and set(tags) == {INTEGER} and parts[1][2] - parts[1][1] >= 16)
        or (version == 1 and tags[1] == OCTETS and parts[1][2] - parts[1][1] >= 16)
        or (version in (0, 1) and len(parts) >= 3 and algorithm(parts[1]) and tags[2] == OCTETS)
        or (len(parts) == 2 and algorithm(parts[0]) and len(children(data, *parts[0][1:]) or ()) == 2 and tags[1] == OCTETS and parts[1][2] - parts[1][1] >= 32)
    )
    return whole[2] if good else 0


def is_ssh_key(data: bytes) -> bool:
    """The private key file of OpenSSH: a magic word, then length-prefixed fields to the end."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, fields = len(magic), []
    while len(fields) < 3 and at + 4 <= len(data):  # cipher, key derivation, its options
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    if len(fields) < 3 or not fields[0] or at + 4 > len(data):
        return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    for _ in range(keys + 1):  # public parts, then the private ones together
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return 1 <= keys <= 16 and at == len(data)


def is_signed_token(parts: list[str]) -> bool:
    """Header and payload (or the five parts of an encrypted token) decode, and the header is
    an object that names its algorithm."""
    head = decoded(parts[0])
    if head is None or len(parts) not in (3, 5):
        return False
    try:
        header = json.loads(head)
        if not isinstance(header, dict) or not isinstance(header.get("alg"), str):
            return False
        if len(parts) == 5:
            return isinstance(header.get("enc"), str) and all(decoded(p) is not None for p in parts[1:])
        body = decoded(parts[1])
        return body is not None and isinstance(json.loads(body), dict) and decoded(parts[2]) is not None
    except (ValueError, RecursionError):
        return False


def token_spans(text: str) -> Iterator[Span]:
    """Signed and encrypted tokens; one ends with its last part, whatever dots and words follow."""
    at = 0
    while match := JWT.search(text, at):
        at, parts = match.start() + 1, match[0].split(".")
        for count in (5, 3):
            if len(parts) >= count and is_signed_token(parts[:count]):
                at = match.start() + len(".".join(parts[:count]))
                yield match.start(), at, KINDS.index("jwt")
                break


def pem_blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, what is between) of every begin marker with an end of its label; the first such end counts.

    All markers are found in one pass, so markers without an end cost no search of their own.
    """
    ends: dict[str, list[tuple[int, int]]] = {}
    for m in PEM_END.finditer(text):
        ends.setdefault(m[1], []).append(m.span())
    at = 0
    for m in PEM_BEGIN.finditer(text):
        later = ends.get(m[1], [])
        n = bisect.bisect_left(later, (m.end(),))
        if m.start() >= at and n < len(later):
            yield m.start(), later[n][1], text[m.end() : later[n][0]]
            at = later[n][1]


def pem_body(text: str) -> str:
    """The lines between the markers, also where they stand in a string of JSON or source code, with
    escaped line ends and slashes or as strings put together."""
    return JOINT.sub("", ESCAPED_END.sub("\n", text).replace("\\/", "/"))


def key_spans(start: int, run: str) -> Iterator[Span]:
    """Keys inside one run of base64 signs; their own lengths say where they end."""
    data = decoded(run)
    if data is not None and is_ssh_key(data):
        yield start, start + len(run), KINDS.index("ssh")
        return
    at = 0
    while match := DER_START.search(run, at):
        at = match.start() + 1
        head = decoded(run[match.start() : match.start() + 8])
        whole = element(head + b"\0", 0, 1 << 40) if head and len(head) == 6 and head[0] == SEQUENCE else None
        if not whole:
            continue
        signs = -(-whole[2] * 4 // 3)
        body = run[match.start() : match.start() + signs]
        data = decoded(body) if len(body) == signs else None
        if data is not None and private_key_length(data) == whole[2]:
            end = match.start() + signs
            end += min(-signs % 4, len(run) - len(run[end:].lstrip("=")) - end)
            yield start + match.start(), start + end, KINDS.index("der")
            at = end


def base_spans(text: str) -> list[Span]:
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return found


def confirmed_spans(text: str) -> list[Span]:
    found = list(token_spans(text))
    taken = []
    for start, end, body in pem_blocks(text):
        lines = [line for line in pem_body(body).splitlines() if ":" not in line]
        sealed = "Proc-Type: 4,ENCRYPTED" in body
        data = decoded("".join("".join(lines).split()))
        if data and (private_key_length(data) == len(data) or is_ssh_key(data) or sealed and len(data) % 8 == 0):
            found.append((start, end, KINDS.index("pem")))
            taken.append((start, end))
    for m in RUN.finditer(text):
        n = bisect.bisect_right(taken, (m.start(), len(text)))
        if not n or taken[n - 1][1] <= m.start():
            found += key_spans(m.start(), m[0])
    for m in HEX_RUN.finditer(text):
        data = bytes.fromhex(m[0])
        size = private_key_length(data)
        if size and size == len(data) or is_ssh_key(data):
            found.append((m.start(), m.end(), KINDS.index("der" if size else "ssh")))
    return found


def spans(text: str) -> list[Span]:
    """All spans of ``text`` in code points, by start, then kind; a span is listed once."""
    return sorted(set(base_spans(text) + confirmed_spans(text)), key=lambda s: (s[0], s[2], s[1]))


def worth_reading(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows hold a run of 32 base64 signs, a word that announces a secret, or a marker.

    All that is reported needs one of these; the test is one pass over the bytes of a batch.
    """
    sign = np.zeros(256, bool)
    sign[[b for b in range(128) if chr(b).isalnum() or chr(b) in "+/_-"]] = True
    inside = sign[data]
    inside = np.concatenate([[False], inside, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    long_ = edges[::2][np.diff(edges)[::2] >= SHORTEST_RUN] if len(edges) else edges
    rows = np.zeros(len(offsets), bool)
    # A run that reaches over the end of a row is tested for both; more is read, never less.
    ends = edges[1::2][np.diff(edges)[::2] >= SHORTEST_RUN] if len(edges) else edges
    for places in (long_, ends - 1):
        rows[np.searchsorted(offsets, places, side="right") - 1] = True
    whole = data.tobytes()
    for hint, source in [(h, whole.lower()) for h in HINTS] + [(b"AKIA", whole), (b"ey", whole), (b"-----BEGIN", whole)]:
        at = source.find(hint)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, side="right")) - 1
            rows[row] = True
            at = source.find(hint, int(offsets[row + 1]) if row + 1 < len(offsets) else len(source))
    return rows[: len(offsets) - 1]


def find_secrets(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row's doc_id and ``spans`` (kind, start, end in code points, end exclusive; ``base``
    for those by pattern alone), in order. Null and empty texts have none, repeated rows are
    judged each, a text of any length is read whole. Extra columns are not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = "doc_id long, spans array<struct<kind: string, start: int, end: int, base: boolean>>"

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = batch.column(1)
        found: list[list] = [[]] * batch.num_rows
        for n in np.flatnonzero(worth_reading(*utf8(texts))).tolist():
            found[n] = [
                {"kind": KINDS[k], "start": a, "end": b, "base": k < BASE_KINDS} for a, b, k in spans(texts[n].as_py())
            ]
        yield {"doc_id": batch.column(0), "spans": found}

    return by_batch(rows, schema, run)
