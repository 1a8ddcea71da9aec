import base64
import binascii
import hashlib
import json
import random
import re
import time

import pytest

from helpers import ODD_ROWS, SF, data, frame

from fleetspark.llm import secrets

BASE = {"assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
        "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}


def brute(text):
    out = []
    for i, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            if len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= (20 if kind == "access" else 24):
                out.append((m.start(), i, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def test_base_spans_equal_plain_search():
    rnd = random.Random(5)
    parts = ["password", "PassWd", "token", "api_key", "apikey", "secret", "=", ":", " ", '"', "'", "abcdef", "x", "é", "漢", "AKIA", "ABCD1234EFGH5678", "0123abcd", "fade", "😀", "ſecret", "-"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert [x for x in secrets.code_point_spans(text.encode()) if x[0] in secrets.BASE_KINDS] == brute(text), text


def test_checksums_and_structure():
    body = "aB3" * 10
    good = "ghp_" + body + secrets.checksum62(body.encode())
    npm = "npm_" + body + secrets.checksum62(body.encode())
    enc = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    jwt = f"{enc({'alg': 'HS256'})}.{enc({'sub': 1})}.c2ln"
    pem = "-----BEGIN RSA PRIVATE KEY-----\n" + base64.b64encode(b"\x30\x82" + b"k" * 40).decode() + "\n-----END RSA PRIVATE KEY-----"
    kinds = lambda t: [k for k, _, _ in secrets.code_point_spans(t.encode())]
    assert kinds(f"é {good} {npm} {jwt} {pem}") == ["github", "npm", "jwt", "pem"]
    assert kinds(good[:-1] + ("a" if good[-1] != "a" else "b")) == []
    assert kinds(f"{enc({'x': 1})}.{enc({'sub': 1})}.c2ln") == []
    assert kinds(pem.replace("MII", "AII").replace("MI", "AA")) == []


def test_openssh_keys_and_pem_headers():
    kinds = lambda t: [k for k, _, _ in secrets.code_point_spans(t.encode())]
    pem = lambda label, body, head="": f"-----BEGIN {label}PRIVATE KEY-----\n{head}{base64.encodebytes(body).decode()}-----END {label}PRIVATE KEY-----"
    openssh, der, cipher = b"openssh-key-v1\0" + b"k" * 80, b"\x30\x82" + b"k" * 60, b"\x99" * 64
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABB\n\n"
    assert kinds(pem("OPENSSH ", openssh)) == kinds(pem("RSA ", cipher, head)) == kinds(pem("", der, "Comment: x, y\n\n")) == ["pem"]
    assert kinds(pem("RSA ", cipher, head.replace("\n", "\r\n"))) == kinds(pem("RSA ", der)) == ["pem"]
    for odd in (pem("RSA ", openssh), pem("OPENSSH ", b"openssh-key-v2\0"), pem("RSA ", cipher), pem("RSA ", cipher[1:], head), pem("RSA ", cipher, "Comment: x\n\n")):
        assert kinds(odd) == []


def test_operator_on_odd_rows(spark):
    rows = ODD_ROWS + [(9, 'ok token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"', "x")]
    got = data(secrets.scan_secrets(frame(spark, rows)), "doc_id", "base_sha256", "n_assign", "n_hex")
    want = sorted(((i, digest(brute(t)), sum(x[0] == "assign" for x in brute(t)), sum(x[0] == "hex" for x in brute(t))) for i, t, _ in rows), key=str)
    assert got == want
    assert secrets.scan_secrets(frame(spark, [])).count() == 0


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(((r.doc_id, digest(brute(r.text))) for r in docs.collect()), key=str)
    assert data(secrets.scan_secrets(docs), "doc_id", "base_sha256") == want


JWT = re.compile(rb"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")
PEM = re.compile(rb"-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY-----[ \t]*+\r?+\n?+"
                 rb"((?:[A-Za-z0-9-]++:[^\r\n]*+\r?+\n(?:[ \t][^\r\n]*+\r?+\n)*+)*+)([A-Za-z0-9+/=\s]++)-----END ")


def part(data):
    try:
        found = json.loads(base64.urlsafe_b64decode(data + b"=" * (-len(data) % 4)))
    except (binascii.Error, ValueError):
        return {}
    return found if isinstance(found, dict) else {}


def plain_spans(raw):
    """Tokens and keys by one pattern each, tried at every place."""
    out, over = [], 0
    for m in map(lambda i: JWT.match(raw, i), range(len(raw))):
        if m and m.start() >= over and "alg" in part(m[1]) and (part(m[2]) or b64(b"{}") == m[2]):
            out.append((m.start(), "jwt", over := m.end()))
    over = 0
    for m in map(lambda i: PEM.match(raw, i), range(len(raw))):
        if m and m.start() >= over:
            try:
                body = base64.b64decode(b"".join(m[3].split()), validate=True)
            except (binascii.Error, ValueError):
                continue
            sealed = re.search(rb"^Proc-Type:[ \t]*4,[ \t]*ENCRYPTED\b.*^DEK-Info:", m[2], re.M | re.S)
            if body and len(body) % 8 == 0 if sealed else body[:1] == b"0" or m[1] == b"OPENSSH " and body.startswith(secrets.OPENSSH_MAGIC):
                out.append((m.start(), "pem", over := m.end()))
    return sorted(out)


def b64(data):
    return base64.urlsafe_b64encode(data).rstrip(b"=")


PIECES = {
    "jwt": [b64(b'{"alg":"x"}'), b64(b'{"typ":1, "alg":[{"a":1}]} '), b64(b'{"a":2}'), b64(b'{"alg":"\xff"}'), b64(b'{"alg":"\xc3\xa9"}'), b"eyJ", b"eyJhbGc",
            b64(b'{"x":"'), b"x", b"-_", b64(b'\xff{"alg":1}')[1:], b".", b".", b".", b" ", b"eyJ9"],
    "pem": [b"-----BEGIN PRIVATE KEY-----", b"-----BEGIN RSA PRIVATE KEY-----\n", b"-----BEGIN OPENSSH PRIVATE KEY-----\r\n", b"\n", b"\n", b"A: b\n", b"A:",
            b"Proc-Type: 4,ENCRYPTED\n", b"Proc-Type: 4,ENCRYPTED", b"DEK-Info: x\n", b"DEK-Info:", b" more\n", b"MAAAAAAA", b"MAAAAAAAAAA=", b"AAAAAAAAAAA=",
            base64.b64encode(secrets.OPENSSH_MAGIC + b"k"), b"-----END RSA", b"-----END ", b"-----END ", b"\r"],
}


@pytest.mark.parametrize("kind", PIECES)
def test_checked_kinds_equal_plain_patterns(kind):
    rnd, found = random.Random(3), 0
    for _ in range(6000):
        raw = b"".join(rnd.choices(PIECES[kind], k=rnd.randint(2, 12)))
        want = plain_spans(raw)
        assert [(s, k, e) for s, k, e in secrets.byte_spans(raw) if k in ("jwt", "pem")] == want, raw
        found += len(want)
    assert found > 20


TAIL = b"." + b64(b'{"a":1}') + b".x"


@pytest.mark.parametrize("raw", [b"eyJ" * 333_000, b"eyJ" * 333_000 + TAIL, b64(b'{"a":1,' * 120_000) + TAIL, b"eyJa." * 200_000,
                                 b"-----BEGIN PRIVATE KEY-----\nA:b\n" * 30_000, b"A:-----BEGIN PRIVATE KEY-----\n" * 33_000,
                                 b"-----BEGIN PRIVATE KEY-----A:" * 33_000, b"-----BEGIN " + b"A " * 500_000, b"password=" * 110_000, b"a" * 1_000_000],
                         ids=["run", "head", "json", "parts", "headers", "chain", "line", "open", "assign", "hex"])
def test_long_texts_take_time_by_their_size(raw):
    start = time.process_time()
    secrets.byte_spans(raw)
    assert time.process_time() - start < 10
