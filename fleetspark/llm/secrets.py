"""Secret scan: Aho-Corasick keyword prefilter, anchored patterns near hits, checksum validation.

One Aho-Corasick pass over the case-folded text finds the literal keywords of
the keyed kinds. Hex runs have no literal keyword, so a second pass runs over
the text folded to "hex digit or not", with a run of 24 hex marks as keyword.
Only at a hit is a regular expression tried, anchored at the hit. Kinds that
carry a checksum or a checkable structure are kept only if it holds:

* ``github``, ``npm``: the last six characters are the base-62 CRC-32 of the
  thirty characters after the prefix;
* ``jwt``: the first two parts are base64url JSON objects, the first with ``alg``;
* ``pem``: the body between the markers, after any header lines, is base64 and starts with a DER sequence
  or, in an OPENSSH key, with OpenSSH's magic; a body that its headers call encrypted is whole cipher blocks.

Defined results: a null text counts as empty (no spans, the digest of the empty
string); repeated rows give repeated results; other columns are ignored, so
their names cannot clash. Text of any length is scanned whole, in linear time: what several starts
lead to (the rest of a token, header lines, a body) is read once.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import map_texts, sha256, utf8

#: Order in which kinds with the same start are listed.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
BASE_KINDS = ("assign", "access", "hex")

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
CHECKED = re.compile(rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT_RUN = re.compile(rb"[A-Za-z0-9_-]++")
PEM_OPEN = re.compile(rb"-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY-----[ \t]*+\r?+\n?+")
HEADER_NAME = re.compile(rb"[A-Za-z0-9-]++:")
LINE = re.compile(rb"[^\r\n]*+")
#: The end of a header line, and the lines that go on with it.
HEADER_END = re.compile(rb"\r?+\n(?:[ \t][^\r\n]*+\r?+\n)*+")
PEM_BODY = re.compile(rb"([A-Za-z0-9+/=\s]++)-----END ")
PROC_TYPE = rb"Proc-Type:[ \t]*4,[ \t]*ENCRYPTED\b"
PROC_HERE, PROC_LINE, DEK_LINE = re.compile(PROC_TYPE), re.compile(rb"^" + PROC_TYPE, re.MULTILINE), re.compile(rb"^DEK-Info:", re.MULTILINE)
#: Valid UTF-8, lone surrogates included.
UTF8 = re.compile(rb"(?:[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xef][\x80-\xbf]{2}"
                  rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})*+")
JSON_REST = re.compile(r"[ \t\n\r]*+\Z")
OPENSSH_MAGIC = b"openssh-key-v1\0"
CIPHER_BLOCK = 8

KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign",
    "apikey": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github",
    "ghs_": "github", "ghr_": "github", "npm_": "npm", "eyj": "jwt", "-----begin ": "pem",
}
HEX_RUN = 24
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX_FOLD = bytes(ord("h") if chr(b) in "0123456789abcdef" else ord(".") for b in range(256))


@lru_cache(maxsize=1)
def _automata():
    import ahocorasick

    words = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        words.add_word(word, (kind, len(word)))
    words.make_automaton()
    runs = ahocorasick.Automaton()
    runs.add_word("h" * HEX_RUN, HEX_RUN)
    runs.make_automaton()
    return words, runs


def checksum62(body: bytes) -> str:
    """CRC-32 of the body as six base-62 digits."""
    value, digits = zlib.crc32(body), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = BASE62[d] + digits
    return digits


class _Line(str):
    """Text of one line for the JSON parser, so that an error does not count the lines before it."""

    def count(self, *_):
        return 0

    def rfind(self, *_):
        return -1


class _Jsons:
    """JSON objects that end a run of base64url symbols, by their start; starts that differ by fours share one decoding."""

    scan = staticmethod(json.JSONDecoder().scan_once)

    def __init__(self, raw: bytes, stop: int):
        self.raw, self.stop, self.decoded = raw, stop, {}

    def at(self, start: int) -> dict | None:
        n = self.stop - start
        if n % 4 == 1:
            return None
        if n % 4 not in self.decoded:
            data = base64.urlsafe_b64decode(self.raw[start:self.stop] + b"=" * (-n % 4))
            valid = 0
            while (end := UTF8.match(data, valid).end()) < len(data):
                valid = end + 1
            self.decoded[n % 4] = start, valid, _Line(data.decode("latin-1"))  # JSON's own symbols are ASCII
        first, valid, text = self.decoded[n % 4]
        at = (start - first) // 4 * 3
        if at < valid:
            return None
        try:
            found, end = self.scan(text, at)
        except (ValueError, StopIteration, RecursionError):
            return None
        return found if isinstance(found, dict) and JSON_REST.match(text, end) else None


class _Jwts:
    """JSON web tokens of a text, asked for by ascending start. All starts in one run of symbols share what follows it."""

    def __init__(self, raw: bytes):
        self.raw, self.run_end, self.end, self.heads = raw, 0, None, None

    def _follow(self, start: int) -> None:
        raw, self.end = self.raw, None
        self.run_end = JWT_RUN.match(raw, start).end()
        if not raw.startswith(b".eyJ", self.run_end):
            return
        second = JWT_RUN.match(raw, self.run_end + 1)
        third = JWT_RUN.match(raw, second.end() + 1) if raw[second.end():second.end() + 1] == b"." else None
        if third and second.end() - second.start() > 3 and _Jsons(raw, second.end()).at(second.start()) is not None:
            self.end, self.heads = third.end(), _Jsons(raw, self.run_end)

    def end_at(self, start: int) -> int | None:
        if not self.raw.startswith(b"eyJ", start):
            return None
        if start >= self.run_end:
            self._follow(start)
        if self.end is None or self.run_end - start < 4:
            return None
        head = self.heads.at(start)
        return self.end if head and "alg" in head else None


class _Pems:
    """PEM private keys of a text, asked for by ascending start. Header lines and bodies that several openings lead to are read once."""

    def __init__(self, raw: bytes):
        self.raw, self.ends, self.bodies, self.line = raw, {}, {}, (0, -1, None)

    def _after_header(self, at: int) -> int | None:
        """Start of what follows the header line that begins (or goes on) at ``at``."""
        name = HEADER_NAME.match(self.raw, at)
        if not name:
            return None
        low, high, after = self.line
        if not low <= name.end() <= high:
            high = LINE.match(self.raw, name.end()).end()
            m = HEADER_END.match(self.raw, high)
            after = m.end() if m else None
            self.line = name.end(), high, after
        return after

    def _headers_end(self, at: int) -> int:
        passed, keep = [], None
        while at not in self.ends:
            after = self._after_header(at)
            keep = keep or self.line  # the line of the opening: the next opening may lie on it
            if after is None:
                self.ends[at] = at
                break
            passed.append(at)
            at = after
        end = self.ends[at]
        self.ends.update(dict.fromkeys(passed, end))
        self.line = keep or self.line
        return end

    def _body(self, first: int, at: int) -> tuple:
        """End, decoded body, and places of the last line that calls it encrypted and of the line that says how."""
        m = PEM_BODY.match(self.raw, at)
        if not m:
            return None, b"", -1, -1
        try:
            body = base64.b64decode(b"".join(m[1].split()), validate=True)
        except (binascii.Error, ValueError):
            return None, b"", -1, -1
        dek = max((x.start() for x in DEK_LINE.finditer(self.raw, first, at)), default=-1)
        proc = max((x.start() for x in PROC_LINE.finditer(self.raw, first, max(first, dek))), default=-1)
        return m.end(), body, proc, dek

    def end_at(self, start: int) -> int | None:
        m = PEM_OPEN.match(self.raw, start)
        if not m:
            return None
        first = m.end()
        at = self._headers_end(first)
        if at not in self.bodies:
            self.bodies[at] = self._body(first, at)
        end, body, proc, dek = self.bodies[at]
        if end is None:
            return None
        here = PROC_HERE.match(self.raw, first, at)
        if proc >= first or here and here.end() <= dek:
            return end if body and len(body) % CIPHER_BLOCK == 0 else None
        return end if body[:1] == b"\x30" or m[1] == b"OPENSSH " and body.startswith(OPENSSH_MAGIC) else None


def _crc_end(raw: bytes, at: int) -> int | None:
    m = CHECKED.match(raw, at)
    return m.end() if m and checksum62(m[1]) == m[2].decode() else None


def byte_spans(raw: bytes) -> list[tuple[int, int, str]]:
    """Spans (start, kind order as listed, end) in bytes, sorted."""
    words, runs = _automata()
    found = []
    over = dict.fromkeys(KINDS, 0)
    checked = {"github": partial(_crc_end, raw), "npm": partial(_crc_end, raw), "jwt": _Jwts(raw).end_at, "pem": _Pems(raw).end_at}
    # a byte per character, so that offsets are byte offsets
    for end, (kind, n) in words.iter(raw.lower().decode("latin-1")):
        start = end + 1 - n
        if start < over[kind]:
            continue
        if kind == "assign":
            m = ASSIGN.match(raw, start)
            if m:
                over[kind] = m.end()
                if m.end(2) - m.start(2) >= 6:
                    found.append((start, kind, m.end()))
        elif kind == "access":
            m = ACCESS.match(raw, start)
            if m:
                over[kind] = m.end()
                if m.end() - start >= 20:
                    found.append((start, kind, m.end()))
        else:
            stop = checked[kind](start)
            if stop:
                over[kind] = stop
                found.append((start, kind, stop))
    for end, n in runs.iter(raw.translate(_HEX_FOLD).decode("latin-1")):
        start = end + 1 - n
        if start >= over["hex"]:
            m = HEX.match(raw, start)
            over["hex"] = m.end()
            found.append((start, "hex", m.end()))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(((s, k, e) for s, k, e in found), key=lambda x: (x[0], order[x[1]]))


def code_point_spans(raw: bytes) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, by start, then kind as listed."""
    spans = byte_spans(raw)
    if not spans or raw.isascii():
        return [(k, s, e) for s, k, e in spans]
    at, n, place = 0, 0, {}
    for b in sorted({x for s, _, e in spans for x in (s, e)}):
        n += len(raw[at:b].decode("utf-8", "replace"))
        at, place[b] = b, n
    return [(k, place[s], place[e]) for s, k, e in spans]


SCHEMA = ("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "found array<struct<kind: string, start: long, stop: long>>")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, counts of the base kinds, span digests and the spans themselves."""
    id_type = docs.schema[id_col].dataType
    src = docs.select(F.col(id_col), utf8(text_col).alias("raw"))

    def step(part: pa.RecordBatch) -> dict:
        out = {c: [] for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "found")}
        for raw in part.column("raw").to_pylist():
            spans = code_point_spans(raw)
            base = [x for x in spans if x[0] in BASE_KINDS]
            for kind in BASE_KINDS:
                out[f"n_{kind}"].append(sum(x[0] == kind for x in base))
            joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
            out["base_sha256"].append(sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()))
            out["spans"].append(joined)
            out["found"].append([{"kind": k, "start": s, "stop": e} for k, s, e in spans])
        found = pa.array(out.pop("found"), pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])))
        return {id_col: part.column(0), **{c: pa.array(v, pa.int64() if c[:2] == "n_" else pa.string()) for c, v in out.items()},
                "found": found}

    return map_texts(src, step, f"`{id_col}` {id_type.simpleString()}, {SCHEMA}")
