"""Exact token counts of every prefix by prefix dynamic programming.

A byte-level BPE encodes each piece of a text (as its cutting pattern makes them) on its own. Inside a
piece every byte prefix has one valid last token: the token that ends there and that no merge over the border joins
to the last token of the prefix before it. So ``tokens(prefix) = tokens(prefix without its last token) + 1``, and one
pass over a piece leaves the count of every prefix of it. With the running sum over pieces this answers
how many tokens a cut text has, and where to cut for a budget, without encoding anything again
(``PrefixTable``).

The counts are those of the ``tokenizers`` library for the vocabulary file: its special strings count as one token
each wherever they stand (its default), begin and end tokens are not added. The library's own Unicode
tables decide what is a letter, a number or white space; they are read from it once (``CutRules``).

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows give repeated results; an empty
table gives none; other columns, also those named like the results, are ignored. A piece of n bytes
takes O(n) steps, so very long texts and words need no special case; a long text holds its pieces in memory.
"""

from __future__ import annotations

import json
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import map_texts, utf8

#: Pieces that one generation of a worker's memo holds (a count each), and the longest piece it keeps.
MEMO_PIECES, MEMO_LENGTH = 400_000, 64
#: Pieces up to this many bytes look their substrings up; longer ones are read by an automaton.
SHORT = 40
_NEVER = 1 << 60


class Merges:
    """Tokens and merge ranks of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE")
        byte = {c: b for b, c in enumerate(_byte_letters())}
        raw = {text: bytes(byte[c] for c in text) for text in model["vocab"]}
        self.size = 1 + max(model["vocab"].values())
        self.ids = {raw[text]: i for text, i in model["vocab"].items()}
        self.rank: dict[int, int] = {}      # pair of tokens -> rank of its merge
        self.parts: dict[int, tuple] = {}   # token -> its two parts and the rank that joins them
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, made = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            if made in self.parts:
                raise ValueError(f"two merges make token {made}")
            self.rank[left * self.size + right] = rank
            self.parts[made] = (left, right, rank)
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has special tokens with rules of their own")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: printable Latin-1 for itself, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class CutRules:
    """The cutting pattern with the character classes of the library that defines the counts.

    ``odd`` holds the characters which the local ``regex`` module classes otherwise (it knows a
    later Unicode); texts without them take the plain pattern, which is faster."""

    PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    #: Planes with assigned characters; all others are neither letters, numbers nor white space.
    PLANES = (range(0, 0xD800), range(0xE000, 0x40000), range(0xE0000, 0xE0200))

    def __init__(self, odd: dict[str, str]):
        import regex

        self.odd = frozenset(odd)
        of = {k: "".join(regex.escape(c) for c, kind in odd.items() if kind == k) for k in "LNSO"}
        none = "".join(map(regex.escape, odd))
        sets = {k: rf"[[{base}]--[{none}]{'||[' + of[k] + ']' if of[k] else ''}]" if none else f"[{base}]"
                for k, base in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))}
        letters, numbers, space = sets["L"], sets["N"], sets["S"]
        self.plain = regex.compile(self.PLAIN)
        self.exact = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letters}+| ?{numbers}+| ?(?:(?!{space}|{letters}|{numbers})[\s\S])+"
                                   rf"|{space}+(?:(?={space})|$)|{space}+", regex.V1) if odd else self.plain

    @staticmethod
    def library_differences(path: str) -> dict[str, str]:
        """Characters that the library classes unlike the ``regex`` module, with the library's class."""
        import regex
        from tokenizers import Tokenizer

        cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        local = [(k, regex.compile(p).match) for k, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))]
        odd = {}
        for plane in CutRules.PLANES:
            for start in range(plane.start, plane.stop, 4096):
                block = [chr(c) for c in range(start, min(start + 4096, plane.stop))]
                ends = {end for _, (_, end) in cut("".join(f"1{c}{c}a" for c in block))}
                for i, c in enumerate(block):
                    joins_one, joins_self, joins_a = (4 * i + k not in ends for k in (1, 2, 3))
                    kind = "N" if joins_one else "L" if joins_a and joins_self else "O" if joins_self else "S"
                    if kind != next((k for k, match in local if match(c)), "O"):
                        odd[c] = kind
        return odd

    def pattern(self, text: str):
        return self.plain if text.isascii() or self.odd.isdisjoint(text) else self.exact


class Counter(dict):
    """Pieces to token counts; computes what it lacks. Two generations bound it, and frequent pieces stay."""

    def __init__(self, merges: Merges):
        import ahocorasick

        super().__init__()
        self.merges, self.old, self.borders = merges, {}, {}
        self.reach = max(map(len, merges.ids))
        self.automaton = ahocorasick.Automaton()
        for data, token in merges.ids.items():
            self.automaton.add_word(data.decode("latin-1"), (token, len(data)))
        self.automaton.make_automaton()

    def __missing__(self, piece: str) -> int:
        n = self.old.get(piece)
        if n is None:
            n = self.prefix_counts(piece.encode())[-1]
        if len(piece) <= MEMO_LENGTH:
            self._keep(piece, n)
        return n

    def borders_hold(self, first: int, second: int) -> bool:
        """Whether merging the bytes of both tokens ends with just these two: no merge over the border comes
        before the merges that build their edges (of equal ranks the left one goes first)."""
        parts, rank, size = self.merges.parts, self.merges.rank, self.merges.size
        edge = [(first, _NEVER)]  # tokens at the border, outermost first, with the rank that absorbs each
        while edge[-1][0] in parts:
            _, inner, at = parts[edge[-1][0]]
            edge.append((inner, at))
        other = [(second, _NEVER)]
        while other[-1][0] in parts:
            inner, _, at = parts[other[-1][0]]
            other.append((inner, at))
        while True:
            (a, a_at), (b, b_at) = edge[-1], other[-1]
            over = rank.get(a * size + b, _NEVER)
            if over < a_at and over <= b_at and over != _NEVER:
                return False
            if len(edge) == 1 and len(other) == 1:
                return True
            (edge if a_at <= b_at else other).pop()

    def _fits(self, first: int, second: int) -> bool:
        key = first * self.merges.size + second
        known = self.borders.get(key)
        if known is None:
            if len(self.borders) >= 1_000_000:
                self.borders.clear()
            known = self.borders[key] = self.borders_hold(first, second)
        return known

    def _append(self, data: bytes, known: int, last: list[int], counts: list[int]) -> None:
        """Fill the states of the prefixes of ``data`` that are longer than ``known``; shorter ones are right already."""
        token_of, borders, fits, size = self.merges.ids.get, self.borders.get, self._fits, self.merges.size
        for end in range(known + 1, len(data) + 1):
            for start in range(end - 1, -1, -1):  # only one token is valid, and it is mostly short
                token = token_of(data[start:end])
                if token is None:
                    continue
                if start:
                    ok = borders(last[start] * size + token)
                    if not (fits(last[start], token) if ok is None else ok):
                        continue
                last[end], counts[end] = token, counts[start] + 1
                break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def learn(self, pieces: set[str]) -> None:
        """Count the short pieces that are not known yet, in byte order: a piece keeps the states of
        the prefix that it shares with the piece before it and appends the rest."""
        fresh = sorted((p.encode(), p) for p in pieces if len(p) <= SHORT and p not in self and p not in self.old)
        last, counts, before = [0] * (4 * SHORT + 1), [0] * (4 * SHORT + 1), b""
        for data, piece in fresh:
            known, most = 0, min(len(data), len(before))
            while known < most and data[known] == before[known]:
                known += 1
            self._append(data, known, last, counts)
            before = data
            self._keep(piece, counts[len(data)])

    def _keep(self, piece: str, n: int) -> None:
        if len(self) >= MEMO_PIECES:
            self.old = dict(self)
            self.clear()
        self[piece] = n

    def prefix_counts(self, data: bytes) -> list[int]:
        """Token count of every byte prefix of one piece (entry 0: the empty prefix)."""
        last, counts = [0] * (len(data) + 1), [0] * (len(data) + 1)
        if len(data) <= SHORT:
            self._append(data, 0, last, counts)
            return counts
        for at, (token, width) in self.automaton.iter(data.decode("latin-1")):
            end, start = at + 1, at + 1 - width
            if not counts[end] and (not start or self._fits(last[start], token)):
                last[end], counts[end] = token, counts[start] + 1
        if not all(counts[1:]):
            raise ValueError("the vocabulary lacks a byte")
        return counts


class PrefixTable:
    """Counts of one text: of its pieces' ends, and of any prefix by the piece it ends in."""

    def __init__(self, coder: "TokenCounter", text: str):
        self.coder, self.text = coder, text
        self.starts, self.kinds, counts = [], [], []
        for begin, end, special in coder.segments(text):
            if special:
                self.starts.append(begin)
                self.kinds.append(True)
                counts.append(1)
                continue
            stretch = text[begin:end]
            for m in coder.rules.pattern(stretch).finditer(stretch):
                self.starts.append(begin + m.start())
                self.kinds.append(False)
                counts.append(coder.counts[m.group()])
        self.ends = [*self.starts[1:], len(text)]
        self.before = [0, *accumulate(counts)]

    @property
    def total(self) -> int:
        return self.before[-1]

    def at(self, length: int) -> int:
        """Exact count of ``text[:length]``: pieces before the cut stay; what the cut can change, the last pieces, is cut anew."""
        import bisect

        if length >= len(self.text):
            return self.total
        k = bisect.bisect_left(self.starts, length) - 1
        if k < 0:
            return 0
        # a cut may lengthen the white space before it, and turn a special string into ordinary text
        while k and (self.text[self.starts[k]:length].isspace() or self.kinds[k]) and not (self.kinds[k] and self.ends[k] <= length):
            k -= 1
            if self.kinds[k]:
                k += 1
                break
        return self.before[k] + self.coder.count(self.text[self.starts[k]:length])

    def every(self) -> np.ndarray:
        """Counts of all prefixes, by length in code points (entry 0: the empty prefix)."""
        out = np.zeros(len(self.text) + 1, np.int64)
        run_start = None
        for k, (start, end) in enumerate(zip(self.starts, self.ends)):
            piece = self.text[start:end]
            base = self.before[k]
            if self.kinds[k] or (piece[0] == "'" and len(piece) > 1) or (k + 1 < len(self.kinds) and self.kinds[k + 1]):
                out[start + 1:end + 1] = [self.at(p) for p in range(start + 1, end + 1)]
                run_start = None
                continue
            width = len(piece) - len(piece.lstrip())
            if width == len(piece) and run_start is None:
                run_start = start
            inside = self.coder.counts.prefix_counts(piece.encode())
            sizes = np.cumsum([len(c.encode()) for c in piece])
            out[start + 1:end + 1] = base + np.asarray(inside)[sizes]
            if run_start is not None:  # prefixes that end in a run of white space see it as one piece
                stop = start + width
                run = self.text[run_start:stop]
                whole = np.asarray(self.coder.counts.prefix_counts(run.encode()))
                sizes = np.cumsum([len(c.encode()) for c in run])
                first = self.before[self.starts.index(run_start, max(0, k - 3), k + 1)]
                out[start + 1:stop + 1] = first + whole[sizes][start - run_start:]
                if width < len(piece):
                    run_start = None
        return out

    def cut_for(self, limit: int, every: np.ndarray | None = None) -> int:
        """Length of the longest prefix with at most ``limit`` tokens."""
        return int(np.flatnonzero((self.every() if every is None else every) <= limit)[-1])


class TokenCounter:
    """Token counts of whole texts for one vocabulary file."""

    def __init__(self, merges: Merges, odd: dict[str, str]):
        import regex

        self.rules, self.counts = CutRules(odd), Counter(merges)
        self.special = regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True)))) if merges.special else None

    def segments(self, text: str) -> list[tuple[int, int, bool]]:
        """Ordinary stretches and special strings of a text, in order; empty stretches are left out."""
        out, at = [], 0
        for m in self.special.finditer(text) if self.special else ():
            if m.start() > at:
                out.append((at, m.start(), False))
            out.append((m.start(), m.end(), True))
            at = m.end()
        if at < len(text):
            out.append((at, len(text), False))
        return out

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pieces of the ordinary stretches of a text, and the number of special strings."""
        out, specials = [], 0
        for begin, end, special in self.segments(text):
            if special:
                specials += 1
            else:
                stretch = text[begin:end]
                out += self.rules.pattern(stretch).findall(stretch)
        return out, specials

    def count(self, text: str) -> int:
        """Tokens of a text: the running sum over its pieces, at its end."""
        return self.count_all([text])[0]

    def count_all(self, texts: list[str]) -> list[int]:
        cut = [self.pieces(text) for text in texts]
        self.counts.learn(set().union(*(pieces for pieces, _ in cut)))
        return [specials + sum(map(self.counts.__getitem__, pieces)) for pieces, specials in cut]


_COUNTERS: dict[tuple, TokenCounter] = {}
_RULES: dict[str, tuple] = {}


def _counter(key: str, spec: tuple) -> TokenCounter:
    """One counter per worker process and vocabulary, so that its bounded memo lives across tasks."""
    found = _COUNTERS.get(key)
    if found is None:
        _COUNTERS.clear()
        found = _COUNTERS[key] = TokenCounter(*spec)
    return found


def rules_of(path: str) -> tuple[Merges, dict[str, str]]:
    """Vocabulary (a published file of fixed size) and the library's character classes, read once per driver."""
    if path not in _RULES:
        _RULES[path] = Merges(path), CutRules.library_differences(path)
    return _RULES[path]


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text",
                 budgets: tuple[int, ...] = (), prefixes: bool = False) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    ``budgets`` adds ``budget_chars``: for each budget the length of the longest prefix that fits. ``prefixes`` adds
    ``prefix_tokens``: the count of every prefix, by its length in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(rules_of(vocabulary_path))
    src = docs.select(F.col(id_col), utf8(text_col).alias("raw"))

    def step(part: pa.RecordBatch) -> dict:
        counter = _counter(vocabulary_path, shared.value)
        raws, cuts, tables = part.column("raw").to_pylist(), [], []
        texts = [raw.decode("utf-8", "replace") for raw in raws]
        if budgets or prefixes:
            totals = []
            for text in texts:
                table = PrefixTable(counter, text)
                totals.append(table.total)
                every = table.every()
                cuts.append([table.cut_for(b, every) for b in budgets])
                tables.append(every.astype(np.int32) if prefixes else None)
        else:
            totals = counter.count_all(texts)
        out = {id_col: part.column(0), "n_bytes": pa.array(list(map(len, raws)), pa.int64()), "n_tokens": pa.array(totals, pa.int64()),
               "over_limit": pa.array([n > limit for n in totals], pa.bool_())}
        if budgets:
            out["budget_chars"] = pa.array(cuts, pa.list_(pa.int64()))
        if prefixes:
            out["prefix_tokens"] = pa.array(tables, pa.list_(pa.int32()))
        return out

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    return map_texts(src, step, schema + (", budget_chars array<long>" if budgets else "") + (", prefix_tokens array<int>" if prefixes else ""))
