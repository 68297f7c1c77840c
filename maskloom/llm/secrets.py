"""Secrets in texts: patterns, and candidates confirmed by what they decode to.

Kinds found by pattern alone (leftmost, not overlapping, per kind): ``assign``, ``access``, ``hex``.
Kinds reported only if their structure holds:

* ``pem``: an armoured private key whose base64 body decodes to a DER value, an OpenSSH key, or (for an
  encrypted or OpenPGP body) to whole base64;
* ``der``: base64 that decodes to a private key in DER: a SEQUENCE that fills the data, whose members
  nest without a gap, starting with a small INTEGER version;
* ``openssh``: base64 that decodes to an OpenSSH private key, its lengths nested within the data;
* ``derhex``: the same as ``der`` in hex, also after ``0x``;
* ``jwt``: a signed token whose header is a JSON object that names an algorithm, with a JSON object as payload.

Escaped line ends count as line ends for these kinds (not for the pattern kinds). Base64 of ``der`` and ``openssh`` may go on
over lines and spaces: its own lengths say how much of it belongs to the key, which must end where a piece ends.
A wrapped key inside a ``pem`` span is not reported again.

Spans are [start, end) in characters of the whole text. Cases: null or empty texts have none; repeated
rows are scanned each; candidates of any length are decoded; other columns are left alone.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.store import lean

# The kinds in their order, the pattern kinds first.
KINDS = ["assign", "access", "hex", "pem", "der", "openssh", "derhex", "jwt"]
BASE = KINDS[:3]
MASK = "[SECRET]"

_ASSIGN = re.compile(
    r"(?ai:(?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_BEGIN = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----")
_END = re.compile(r"(?=-----END ((?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----)")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_HEX_DER = re.compile(r"30(?:(?<![0-9A-Za-z]30)|(?<=0[xX]30))(?:[0-9a-f]{2}|[0-9A-F]{2}){20,}(?![0-9A-Za-z])")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])ey[A-Za-z0-9_-]+\.ey[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
#: A line end or tab as written in JSON, properties and source code; the view keeps its length.
_ESCAPE = re.compile(r"\\+(?:[rnt]|u000[9aAdD])")
_ESCAPED = re.compile(r"\\+(?=[/\s])")
#: What base64 of a DER SEQUENCE with a private key's first lengths, or of an OpenSSH key, begins with; and one piece of it.
_START = re.compile(r"[Mb](?<![A-Za-z0-9+/_-][Mb])(?:(?<=M)[A-I]|(?<=b)3Bl)")
_PIECE = re.compile(r"([A-Za-z0-9+/_-]+)(?:\s|\\+(?=[/\s]))*")
#: Cheap signs without which a keyword assignment cannot be there.
_HINTS = (b"passw", b"secret", b"token", b"api")
_SSH = b"openssh-key-v1\x00"
SPANS = "array<struct<kind: string, start: int, end: int>>"


def unbase64(text: str) -> bytes | None:
    """The bytes of whole base64 (either alphabet, padded or not), else None."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if not body or len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _value(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the DER value at ``at``, if it lies within ``end``."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or start + n > end or data[start] == 0:
            return None
        size, start = int.from_bytes(data[start : start + n], "big"), start + n
        if size < 0x80:
            return None
    return (tag, start, start + size) if start + size <= end else None


def _members(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The values that fill [start, end) without a gap, constructed ones checked inside too."""
    out, waiting = [], [(start, end, True)]
    while waiting:
        at, end, top = waiting.pop()
        while at < end:
            found = _value(data, at, end)
            if found is None:
                return None
            if top:
                out.append(found)
            if found[0] & 0x20:
                waiting.append((found[1], found[2], False))
            at = found[2]
    return out


def is_der_key(data: bytes) -> bool:
    """A private key: SEQUENCE over all of the data, small version, then at least two more members."""
    whole = _value(data, 0, len(data))
    if whole is None or whole[0] != 0x30 or whole[2] != len(data):
        return False
    members = _members(data, whole[1], whole[2])
    if not members or len(members) < 2 or members[0][0] != 0x02:
        return False
    version = data[members[0][1] : members[0][2]]
    if len(version) != 1 or version[0] > 3:
        return False
    tags = [m[0] for m in members[1:]]
    numbers = len(tags) >= 5 and all(t == 0x02 for t in tags[:5])  # RSA, DSA
    wrapped = len(tags) >= 2 and tags[0] == 0x30 and tags[1] == 0x04  # PKCS 8
    curve = tags[0] == 0x04 and (len(tags) == 1 or tags[1] in (0xA0, 0xA1))  # EC
    return numbers or wrapped or curve


def is_ssh_key(data: bytes) -> bool:
    """The magic, then three strings, a count of keys, and as many public keys and a private part in lengths that fit."""
    if not data.startswith(_SSH):
        return False
    at = len(_SSH)

    def string(at: int) -> int | None:
        if at + 4 > len(data):
            return None
        end = at + 4 + int.from_bytes(data[at : at + 4], "big")
        return end if end <= len(data) else None

    for _ in range(3):
        if (at := string(at)) is None:
            return False
    if at + 4 > len(data):
        return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys + 1):
        if (at := string(at)) is None:
            return False
    return True


def _known(data: bytes) -> tuple[int, bool] | None:
    """Bytes of a key that begins like this, and whether these are all; if not, how many say more."""
    if data[0] == 0x30:
        whole = _value(data, 0, 1 << 40)
        if whole is None or data[whole[1] : whole[1] + 2] != b"\x02\x01" or data[whole[1] + 2] > 3:
            return None
        return whole[2], True
    if not data.startswith(_SSH[: len(data)]):
        return None
    at, strings, keys = len(_SSH), 3, None
    while True:
        for _ in range(strings):
            if at + 4 > len(data):
                return at + 4, False
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        if keys is not None:
            return at, True
        if at + 4 > len(data):
            return at + 4, False
        keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if not 1 <= keys <= 16:
            return None
        strings = keys + 1


def _wrapped(text: str, at: int) -> tuple[int, int] | None:
    """End and kind of the key whose base64 starts at ``at`` and may go on over white space."""
    need, whole, pieces, n, end = 12, False, [], 0, at
    while need * 4 <= len(text) * 3 + 3:
        while n * 3 < need * 4:
            m = _PIECE.match(text, at)
            if m is None:
                return None
            pieces.append(m[1])
            n, end, at = n + len(m[1]), m.end(1), m.end()
        body = "".join(pieces)
        data = unbase64(body[: n - (n % 4 == 1)])
        if data is None:
            return None
        if whole:
            kind = 4 if is_der_key(data) else 5 if is_ssh_key(data) else None
            if kind is None or n != -(-need * 4 // 3):
                return None
            return end + len(text[end : end + 2]) - len(text[end : end + 2].lstrip("=")), kind
        known = _known(data)
        if known is None:
            return None
        need, whole = known
    return None


def is_token(text: str) -> bool:
    header, payload, signature = text.split(".")
    try:
        parts = [json.loads((unbase64(p) or b"").decode("utf-8")) for p in (header, payload)]
    except ValueError:
        return False
    if not all(isinstance(p, dict) for p in parts) or not isinstance(parts[0].get("alg"), str):
        return False
    return bool(signature) and unbase64(signature) is not None or parts[0]["alg"].lower() == "none"


def _armoured(kind: str, body: str) -> bool:
    body = _ESCAPED.sub("", _ESCAPE.sub("\n", body))
    lines = [line.strip() for line in body.strip().splitlines()]
    headers = any(":" in line for line in lines)
    data = unbase64("".join(x for x in lines if x and ":" not in x and not x.startswith("=")))
    if data is None:
        return False
    if headers or kind.startswith(("PGP", "ENCRYPTED")):
        return len(data) >= 16
    return is_ssh_key(data) or is_der_key(data)


def _armours(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Start, end, kind and body of what stands between a BEGIN mark and the next END mark of its kind."""
    ends: dict[str, list[int]] = {}
    for m in _END.finditer(text):
        ends.setdefault(m[1], []).append(m.start())
    at = 0
    while ends and (m := _BEGIN.search(text, at)) is not None:
        found = ends.get(m[1], [])
        place = bisect_left(found, m.end())
        if place == len(found):
            at = m.start() + 1
            continue
        end = found[place]
        at = end + len("-----END -----") + len(m[1])
        yield m.start(), at, m[1], text[m.end() : end]


def secrets(text: str | None) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of all secrets of a text, by start, then kind."""
    if not text:
        return []
    out = []
    low = text.encode("utf-8").lower()
    if any(hint in low for hint in _HINTS):
        out += [(*m.span(), 0) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if b"akia" in low:
        out += [(*m.span(), 1) for m in _ACCESS.finditer(text)]
    out += [(*m.span(), 2) for m in _HEX.finditer(text)]
    if b"-----begin " in low:
        out += [(start, end, 3) for start, end, kind, body in _armours(text) if _armoured(kind, body)]
    armour = [s[:2] for s in out if s[2] == 3]
    if "\\" in text:
        text = _ESCAPE.sub(lambda m: "\n".rjust(len(m[0])), text)
    for m in _BASE64.finditer(text):
        if (data := unbase64(m[0])) is not None:
            if data[:1] == b"0" and is_der_key(data):
                out.append((*m.span(), 4))
            elif data.startswith(_SSH) and is_ssh_key(data):
                out.append((*m.span(), 5))
    done = {s[0]: s[1] for s in out if s[2] in (4, 5)}
    last = 0
    for m in _START.finditer(text):
        at = m.start()
        if at in done:
            last = max(last, done[at])
        elif at >= last and (found := _wrapped(text, at)) is not None:
            last = found[0]
            if not any(a <= at and last <= b for a, b in armour):
                out.append((at, *found))
    out += [(*m.span(), 6) for m in _HEX_DER.finditer(text) if is_der_key(bytes.fromhex(m[0]))]
    if b"ey" in low:
        out += [(*m.span(), 7) for m in _JWT.finditer(text) if is_token(m[0])]
    return sorted(out, key=lambda s: (s[0], s[2]))


def masked(text: str, mask: str = MASK) -> str:
    """The text with every secret replaced; overlapping ones by one mask."""
    out, at = [], 0
    end = -1
    for a, b, _ in secrets(text):
        if a < end:
            end = max(end, b)
            continue
        if end >= 0:
            at = end
        out += [text[at:a], mask]
        end = b
    return "".join(out) + text[max(end, 0) :] if end >= 0 else text


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of all secrets, one row per row of ``docs``."""
    schema = pa.schema([
        ("doc_id", pa.int64()),
        ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))),
    ])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, b, k in secrets(t.as_py())] for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, schema.field("spans").type)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(scan), f"doc_id long, spans {SPANS}")


def mask_secrets(docs: DataFrame) -> DataFrame:
    """The same rows and columns with secrets masked in ``text``; ``n_chars``, where there is one, follows."""

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if (t := v.as_py()) is None else masked(t) for v in batch.column("text")]
            columns = [pa.array(texts, f.type) if f.name == "text" else c for f, c in zip(batch.schema, batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = docs.mapInArrow(lean(mask), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out
