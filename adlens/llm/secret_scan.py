"""Find secrets: three plain patterns, and encoded keys and signed tokens that parse.

A candidate of base-64 (also wrapped over lines) or hexadecimal digits is reported only if what it decodes to is a
private key: a DER key (PKCS#1, PKCS#8, SEC 1, DSA, encrypted PKCS#8) whose nested lengths close exactly on each
other, an OpenSSH key whose length-prefixed fields do, or the PEM text of one of these. A dotted candidate is
reported only if its header and payload are JSON objects and the signature has the length that the header's
algorithm makes. Public keys, certificates, random digits and cut-off keys are not reported.

Spans count code points of the whole text, ends exclusive. Kinds in order: assign, access, hex (the plain patterns,
always reported), key, jwt. Byte searches decide first which patterns can occur in a text at all; each pattern is
linear in the text. A key is at most 64 KB, the most that the two length bytes of a DER key can say.

Defined cases: a null text is empty and has no spans; rows that repeat an id are scanned each by itself; other
columns are ignored, whatever their names; an empty table gives none.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "key", "jwt")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
#: Digits of base-64 or hexadecimal in a row that may hold a key.
LEAST_RUN = 24
#: What is decoded at most for one key; two length bytes cannot say more either.
MOST_BYTES = (1 << 16) + 4

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX)
LINE_END = r"(?:\r?\n[ \t]*|(?:\\r)?\\n)"
RUN = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_RUN},}}(?:{LINE_END}[A-Za-z0-9+/_-]+)*")
HEX_RUN = re.compile(r"[0-9a-fA-F]{%d,}" % (2 * LEAST_RUN))
#: How the first bytes of a DER sequence, of an OpenSSH key and of PEM text look in base-64.
ANCHOR = re.compile(r"M[A-L]|b3BlbnNzaC1rZXktdjE|LS0tLS1CRUdJTi")
HEX_ANCHOR = re.compile(r"30|6f70656e7373682d6b65792d7631|2d2d2d2d2d424547494e", re.IGNORECASE)
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+(?![A-Za-z0-9_-]|\.[A-Za-z0-9_-])")
TOKEN_STARTS = (b"eyJ", b"eyA", b"ewo", b"ew0", b"ewk")

#: DER tags, object identifiers (as DER bytes) and signature lengths by algorithm name.
SEQUENCE, INTEGER, OCTETS, OID, BITS, CONTEXT_0, CONTEXT_1 = 0x30, 0x02, 0x04, 0x06, 0x03, 0xA0, 0xA1
RSA, EC, DSA = bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce3d0201"), bytes.fromhex("2a8648ce380401")
RAW_KEYS = {bytes.fromhex("2b656e"): 32, bytes.fromhex("2b656f"): 56, bytes.fromhex("2b6570"): 32, bytes.fromhex("2b6571"): 57}
PBE = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
SSH = b"openssh-key-v1\0"
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}
RSA_NAMES, LEAST_RSA = ("RS", "PS"), 128

_CLASSES = bytes(
    ord("h") if chr(c) in "0123456789abcdef" else ord("b") if chr(c).isalnum() and c < 128 or chr(c) in "+/_-" else 32
    for c in range(256)
)
_ANY_DIGIT = bytes(ord("b") if c in b"hb" else 32 for c in range(256))


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain patterns, leftmost and not overlapping within a kind."""
    out = []
    low = raw.lower()
    if any(w in low for w in (b"passw", b"secret", b"token", b"api")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if b"h" * LEAST_HEX in raw.translate(_CLASSES):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def opened(data: bytes, at: int) -> tuple[int, int, int] | None:
    """Tag, content start and content end that the DER element at `at` names; the end may lie beyond the data."""
    if at + 2 > len(data):
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        count = size & 0x7F
        if not 1 <= count <= 2 or at + count > len(data):
            return None
        size, at = int.from_bytes(data[at : at + count], "big"), at + count
        if size < (0x80 if count == 1 else 0x100):
            return None
    return tag, at, at + size


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """As `opened`, if the element ends by `end`."""
    one = opened(data, at)
    return one if one and one[2] <= end else None


def elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill a range exactly; None if they do not."""
    out = []
    while at < end:
        one = element(data, at, end)
        if one is None:
            return None
        out.append(one)
        at = one[2]
    return out


def _whole(data: bytes, one: tuple[int, int, int]) -> int | None:
    """A non-negative INTEGER in its shortest form."""
    tag, a, b = one
    if tag != INTEGER or a == b or data[a] >= 0x80 or (b - a > 1 and data[a] == 0 and data[a + 1] < 0x80):
        return None
    return int.from_bytes(data[a:b], "big")


def _numbers(data: bytes, parts: list[tuple[int, int, int]]) -> list[int] | None:
    out = [_whole(data, p) for p in parts]
    return None if None in out else out  # type: ignore[return-value]


def _rsa(data: bytes, parts: list[tuple[int, int, int]]) -> bool:
    numbers = _numbers(data, parts) if len(parts) == 9 else None
    if not numbers or numbers[0] != 0 or min(numbers[1:]) == 0:
        return False
    _, n, _, d, p, q, dp, dq, inverse = numbers
    return abs(p.bit_length() + q.bit_length() - n.bit_length()) <= 1 and d < n and dp < p and dq < q and inverse < p


def _sec1(data: bytes, parts: list[tuple[int, int, int]]) -> bool:
    if not 2 <= len(parts) <= 4 or _whole(data, parts[0]) != 1 or parts[1][0] != OCTETS:
        return False
    kinds = {CONTEXT_0: OID, CONTEXT_1: BITS}
    for tag, a, b in parts[2:]:
        inner = elements(data, a, b)
        if tag not in kinds or not inner or len(inner) != 1 or inner[0][0] not in (kinds[tag], SEQUENCE):
            return False
    return 14 <= parts[1][2] - parts[1][1] <= 72


def _pkcs8(data: bytes, parts: list[tuple[int, int, int]]) -> bool:
    if not 3 <= len(parts) <= 5 or _whole(data, parts[0]) not in (0, 1):
        return False
    if [p[0] for p in parts[1:3]] != [SEQUENCE, OCTETS] or any(p[0] not in (CONTEXT_0, CONTEXT_1, 0x81) for p in parts[3:]):
        return False
    named, inner = elements(data, *parts[1][1:]), elements(data, *parts[2][1:])
    if not named or named[0][0] != OID or len(named) > 2 or not inner or len(inner) != 1:
        return False
    name, (tag, a, b) = data[named[0][1] : named[0][2]], inner[0]
    if name in RAW_KEYS:
        return tag == OCTETS and b - a == RAW_KEYS[name]
    if name == DSA:
        return _whole(data, inner[0]) is not None
    below = elements(data, a, b) if tag == SEQUENCE else None
    if name in (RSA, EC):
        return below is not None and (_rsa if name == RSA else _sec1)(data, below)
    return b - a >= 16


def _encrypted(data: bytes, parts: list[tuple[int, int, int]]) -> bool:
    if [p[0] for p in parts] != [SEQUENCE, OCTETS] or parts[1][2] - parts[1][1] < 32:
        return False
    named = elements(data, *parts[0][1:])
    return bool(named) and len(named) == 2 and named[0][0] == OID and data[named[0][1] : named[0][2]].startswith(PBE)


def der_key(data: bytes) -> bool:
    """Whether these bytes are exactly one DER private key."""
    head = element(data, 0, len(data))
    parts = elements(data, head[1], head[2]) if head and head[0] == SEQUENCE and head[2] == len(data) else None
    if not parts:
        return False
    if _rsa(data, parts) or _sec1(data, parts) or _pkcs8(data, parts) or _encrypted(data, parts):
        return True
    numbers = _numbers(data, parts) if len(parts) == 6 else None
    return bool(numbers) and numbers[0] == 0 and min(numbers[1:]) > 0 and numbers[2] < numbers[1]


def _field(data: bytes, at: int) -> tuple[bytes, int] | None:
    if at + 4 > len(data):
        return None
    end = at + 4 + int.from_bytes(data[at : at + 4], "big")
    return (data[at + 4 : end], end) if end <= len(data) else None


def ssh_size(data: bytes) -> int | None:
    """Bytes of the OpenSSH private key that starts here, if its length-prefixed fields agree."""
    if not data.startswith(SSH):
        return None
    at, fields = len(SSH), []
    for _ in range(3):
        one = _field(data, at)
        if one is None:
            return None
        fields.append(one[0])
        at = one[1]
    count = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= count <= 16:
        return None
    names = []
    for _ in range(count):
        public = _field(data, at)
        inner = _field(public[0], 0) if public else None
        if inner is None:
            return None
        names.append(inner[0])
        at = public[1]
    private = _field(data, at)
    if private is None or len(private[0]) < 16 or len(private[0]) % 8:
        return None
    if fields[0] == b"none":
        kind = _field(private[0], 8)
        if private[0][:4] != private[0][4:8] or kind is None or kind[0] != names[0]:
            return None
    return private[1]


def key_size(data: bytes, deeper: bool = True) -> int | None:
    """Bytes of the private key that starts here: DER, OpenSSH, or PEM text that holds one (up to its last line)."""
    if data[:1] == b"\x30":
        one = element(data, 0, len(data))
        return one[2] if one and der_key(data[: one[2]]) else None
    if data.startswith(SSH):
        return ssh_size(data)
    if deeper and data.startswith(b"-----BEGIN"):
        last = re.search(rb"-----END [A-Z ]+-----\n?", data)
        data = data[: last.end()] if last else data
        return len(data) if key_spans(data.decode("latin-1"), False) else None
    return None


def _unbase(digits: str) -> bytes:
    digits = digits[: len(digits) - (len(digits) % 4 == 1)]
    try:
        return base64.b64decode(digits + "=" * (-len(digits) % 4), altchars=b"-_" if "-" in digits or "_" in digits else None)
    except (binascii.Error, ValueError):
        return b""


def _key_at(data_of: Callable[[int], bytes], binary: bool, deeper: bool) -> int | None:
    """Size of the key that starts here; `data_of` decodes so many bytes, so that only a fitting start is read on."""
    if not binary:
        return key_size(data_of(MOST_BYTES), deeper)
    head = data_of(12)
    one = opened(head, 0)
    if len(head) < 12 or one is None or one[0] != SEQUENCE:
        return None
    # A private key starts with a small version or with an algorithm.
    first = head[one[1] : one[1] + 3]
    if first[0] != SEQUENCE and not (first[:2] == b"\x02\x01" and first[2] <= 1):
        return None
    return key_size(data_of(one[2]), deeper)


def _run_spans(text: str, deeper: bool) -> list[tuple[int, int]]:
    out = []
    for m in RUN.finditer(text):
        starts, offsets, pieces, at = [], [], [], 0
        for piece in re.finditer(r"[A-Za-z0-9+/_-]+", re.sub(r"\\r\\n|\\n", lambda e: " " * len(e[0]), m[0])):
            starts.append(m.start() + piece.start())
            offsets.append(at)
            pieces.append(piece[0])
            at += len(piece[0])
        digits = "".join(pieces)

        def where(i: int, offsets: list[int] = offsets, starts: list[int] = starts) -> int:
            k = bisect_right(offsets, i) - 1
            return starts[k] + i - offsets[k]

        done = 0
        for anchor in ANCHOR.finditer(digits):
            a = anchor.start()
            if a < done:
                continue
            size = _key_at(lambda n, a=a: _unbase(digits[a : a + -(-4 * n // 3)])[:n], anchor[0][0] == "M", deeper)
            if size:
                done = min(len(digits), a + -(-size * 4 // 3))
                end = where(done - 1) + 1
                out.append((where(a), end + min(len(text[end : end + 2]) - len(text[end : end + 2].lstrip("=")), -size % 3)))
    return out


def _hex_spans(text: str) -> list[tuple[int, int]]:
    out = []
    for m in HEX_RUN.finditer(text):
        digits, done = m[0], 0
        for anchor in HEX_ANCHOR.finditer(digits):
            a = anchor.start()
            if a < done:
                continue
            size = _key_at(lambda n, a=a: bytes.fromhex(digits[a : a + 2 * min(n, (len(digits) - a) // 2)]), anchor[0] == "30", True)
            if size:
                done = a + 2 * size
                out.append((m.start() + a, m.start() + done))
    return out


def key_spans(text: str, deeper: bool = True) -> list[tuple[int, int]]:
    """Where private keys in base-64 or hexadecimal digits stand."""
    return sorted({*_run_spans(text, deeper), *_hex_spans(text)})


def _json_object(part: str) -> dict | None:
    try:
        found = json.loads(_unbase(part).decode("utf-8"))
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def signed_token(token: str) -> bool:
    """Whether a dotted candidate is a signed token: header, payload and a signature of the named algorithm."""
    header, payload, signature = token.split(".")
    head = _json_object(header)
    name = head.get("alg") if head else None
    if not isinstance(name, str) or len(signature) % 4 == 1 or name.lower() == "none":
        return False
    if _json_object(payload) is None:
        return False
    size = len(_unbase(signature))
    if name in SIGNATURES:
        return size == SIGNATURES[name]
    return size >= (LEAST_RSA if name.startswith(RSA_NAMES) else 16)


def spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """All (start, kind, end), by start, then kind."""
    out = base_spans(text, raw)
    if b"b" * LEAST_RUN in raw.translate(_CLASSES).translate(_ANY_DIGIT):
        out += [(a, 3, b) for a, b in key_spans(text)]
    if b"." in raw and any(s in raw for s in TOKEN_STARTS):
        out += [(m.start(), 4, m.end()) for m in TOKEN.finditer(text) if signed_token(m[0])]
    return sorted(out)


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id` and `spans` (kind, start, end) of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.array(KINDS, pa.string())
        for batch in batches:
            found, ends = [], [0]
            for raw in batch.column(1).cast(pa.binary()).to_pylist():
                found += spans(raw.decode("utf-8"), raw) if raw else ()
                ends.append(len(found))
            struct = pa.StructArray.from_arrays(
                [
                    kinds.take(pa.array([f[1] for f in found], pa.int32())),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.int64()),
                ],
                ["kind", "start", "end"],
            )
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "spans"])

    return rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, spans {SPANS}")


def _names(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def summary(found: DataFrame) -> DataFrame:
    """Counts of the plain kinds, the digest of their spans, and all spans as text."""

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    plain = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return found.select(
        "id", *[of(k) for k in KINDS[:3]], F.sha2(_names(plain), 256).alias("base_sha256"), _names(F.col("spans")).alias("spans")
    )
