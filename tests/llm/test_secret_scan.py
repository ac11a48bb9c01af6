"""Secret scan: plain patterns against plain regular expressions, keys and tokens built byte by byte."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import re
import struct
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adlens.llm import secret_scan
from adlens.llm.secret_scan import find_secrets, summary

SCHEMA = "doc_id long, text string, id string, spans int, kind string"
BASE = {
    "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}


def plain(text):
    out = [(m.start(), k, name, m.end()) for k, (name, (p, g, least)) in enumerate(BASE.items()) for m in re.finditer(p, text) if len(m[g]) >= least]
    return [(name, a, b) for a, _, name, b in sorted(out)]


def found(text):
    return [(secret_scan.KINDS[k], a, b) for a, k, b in secret_scan.spans(text, text.encode())]


def der(tag, *parts):
    body = b"".join(parts)
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x81, size]) if size < 256 else bytes([0x82]) + size.to_bytes(2, "big")
    return bytes([tag]) + head + body


def number(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


def rsa(bits=1024, seed=1):
    rng = random.Random(seed)
    p, q = (rng.getrandbits(bits // 2) | 1 << (bits // 2 - 1) | 1 for _ in range(2))
    rest = [65537, rng.randrange(1, p * q), p, q, rng.randrange(1, p), rng.randrange(1, q), rng.randrange(1, p)]
    return der(0x30, number(0), number(p * q), *[number(x) for x in rest])


RSA, EC = bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce3d0201")
P256, PBES2 = bytes.fromhex("2a8648ce3d030107"), bytes.fromhex("2a864886f70d01050d")
SEC1 = der(0x30, number(1), der(4, bytes(range(32))), der(0xA0, der(6, P256)), der(0xA1, der(3, b"\0\4" + bytes(64))))
ED = der(0x30, number(0), der(0x30, der(6, bytes.fromhex("2b6570"))), der(4, der(4, bytes(range(7, 39)))))
KEYS = {
    "pkcs1": rsa(),
    "pkcs8": der(0x30, number(0), der(0x30, der(6, RSA), b"\5\0"), der(4, rsa(512, 2))),
    "sec1": SEC1,
    "pkcs8 ec": der(0x30, number(0), der(0x30, der(6, EC), der(6, P256)), der(4, SEC1)),
    "ed25519": ED,
    "encrypted": der(0x30, der(0x30, der(6, PBES2), der(0x30, der(4, bytes(16)))), der(4, bytes(range(80)))),
    "dsa": der(0x30, number(0), number(2**511 + 3), number(2**159 + 1), number(5), number(77), number(99)),
}
PUBLIC = der(0x30, der(0x30, der(6, RSA), b"\5\0"), der(3, b"\0" + der(0x30, number(2**1023 + 1), number(65537))))


def ssh(cipher=b"none"):
    s = lambda b: struct.pack(">I", len(b)) + b
    public = s(b"ssh-ed25519") + s(bytes(32))
    private = struct.pack(">II", 9, 9) + public + s(bytes(64)) + s(b"me@x")
    private += bytes(range(1, 9 - len(private) % 8)) if len(private) % 8 else b""
    return b"openssh-key-v1\0" + s(cipher) + s(b"none") + s(b"") + struct.pack(">I", 1) + s(public) + s(private)


def b64(data):
    return base64.b64encode(data).decode()


def keys_in(text):
    return [(a, b) for k, a, b in found(text) if k == "key"]


@pytest.mark.parametrize("name", KEYS)
def test_der_keys_in_all_encodings(name):
    data = KEYS[name]
    for digits in (b64(data), base64.urlsafe_b64encode(data).decode().rstrip("="), data.hex(), data.hex().upper()):
        text = f"é clé: {digits} fin"
        assert keys_in(text) == [(7, 7 + len(digits))], digits[:40]
    body = b64(data)
    for mark in ("\n", "\r\n", "\\n", "\n    "):
        wrapped = mark.join(body[i : i + 64] for i in range(0, len(body), 64))
        text = f"-----BEGIN PRIVATE KEY-----{mark}{wrapped}{mark}-----END PRIVATE KEY-----"
        start = 27 + len(mark)
        assert keys_in(text) == [(start, start + len(wrapped))], mark
    pem = f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----\n"
    again = b64(pem.encode())
    assert keys_in(f"data={again} ") == [(5, 5 + len(again))]


@pytest.mark.parametrize("name", KEYS)
def test_damaged_keys_are_not_reported(name):
    data = KEYS[name]
    for broken in (data[:-1], data[: len(data) // 2], data[:1] + bytes([data[1] ^ 1]) + data[2:] + b"\0" * 3):
        if not secret_scan.der_key(broken):
            # A whole key inside a damaged wrapping is still a key.
            assert all(a > 2 for a, _ in keys_in(f"x {b64(broken)} y"))
            assert all(a > 2 and "pkcs8" in name for a, _ in keys_in(f"x {broken.hex()} y"))
        else:  # pragma: no cover
            pytest.fail("a damaged key parses")


def test_public_keys_and_random_digits_are_not_reported():
    rng = random.Random(4)
    assert keys_in(b64(PUBLIC)) == [] and keys_in(PUBLIC.hex()) == []
    for _ in range(300):
        data = b"\x30" + bytes(rng.randrange(256) for _ in range(200))
        assert keys_in(b64(data)) == [] and keys_in(data.hex()) == []


def test_openssh_keys():
    for cipher in (b"none", b"aes256-ctr"):
        digits = b64(ssh(cipher))
        body = "\n".join(digits[i : i + 70] for i in range(0, len(digits), 70))
        assert keys_in(f"a\n{body}\nb") == [(2, 2 + len(body))]
    assert keys_in(b64(ssh()[:-9])) == []
    wrong = bytearray(ssh())
    wrong[-120] ^= 1
    assert keys_in(b64(ssh().replace(struct.pack(">II", 9, 9), struct.pack(">II", 9, 8)))) == []


def token(alg, size, payload='{"sub":"1"}', header=None):
    part = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    head = header if header is not None else json.dumps({"alg": alg, "typ": "JWT"})
    return f"{part(head.encode())}.{part(payload.encode())}.{part(bytes(range(size % 256)) + bytes(max(0, size - size % 256)))}"


def test_signed_tokens():
    for alg, size in (("HS256", 32), ("ES256", 64), ("RS256", 256), ("HS512", 64), ("EdDSA", 64)):
        text = f"Bearer {token(alg, size)}, é"
        assert ("jwt", 7, len(text) - 3) in found(text), alg
    for bad in (
        token("HS256", 31), token("none", 32), token("HS256", 32, payload="[1]"), token("", 32, header='["alg"]'),
        token("x", 32, header='{"typ":"JWT"}'), token("HS256", 32)[1:], token("HS256", 32) + ".abcd",
    ):
        assert not [f for f in found(f"t {bad} t") if f[0] == "jwt"], bad


PIECES = ["password", "Passwd ", "SECRET", '" : ', "=", "token", "api_key", "apikey:", "'", " ", "AKIA", "ABCDEFGHIJ0123", "deadbeef",
          "0123456789abcdef", "é", "ſecret=", "toKen=", "\n", "x.y/z+w-v_u=", "aaaaaaaaaaaa"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_plain_patterns(text):
    assert [f for f in found(text) if f[0] in BASE] == plain(text)


def test_linear_in_hostile_texts():
    start = time.time()
    for piece in ("MIIEvQIBADAN", "b3BlbnNzaC1rZXktdjE", "password ", "eyJhbGciOiJ", "3082013002", "A" * 50 + "\n", "token:", "e" * 64):
        text = piece * (300_000 // len(piece))
        secret_scan.spans(text, text.encode())
    assert time.time() - start < 60


def test_operator_and_summary(spark):
    key = b64(KEYS["pkcs1"])
    texts = [
        (1, "é password = 'abcdefghijkl' AKIA0123456789ABCD"), (1, "again 0123456789abcdef"), (None, None), (3, ""),
        (2**60 + 1, f"key {key} end"), (None, "token=short"), (2**60 + 3, "x" * 300_000 + " secret: abcdefghijklm"),
    ]
    df = spark.createDataFrame([(i, t, "x", 1, "k") for i, t in texts], SCHEMA)
    got = summary(find_secrets(df.coalesce(1))).collect()
    assert sorted(str(r.id) for r in got) == sorted(str(i) for i, _ in texts)
    for i, t in texts:
        want = plain(t or "")
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        same = [r for r in got if r.id == i and r.base_sha256 == digest]
        assert same and same[0].spans == ",".join(f"{k}:{a}:{b}" for k, a, b in found(t or ""))
        assert (same[0].n_assign, same[0].n_access, same[0].n_hex) == tuple(sum(w[0] == k for w in want) for k in BASE)
    assert any(f"key:4:{4 + len(key)}" in r.spans for r in got)
    assert summary(find_secrets(df.limit(0))).collect() == []


def test_query_matches_plain_patterns(spark):
    from adlens.llm.queries import op13_secret_scan

    sf = "/root/testdata/sf0.001"
    want = {r.doc_id: plain(r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op13_secret_scan(spark, sf).collect():
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith(("key", "jwt"))] == [x for x in text.split(",") if x]
