"""Exact removal of long repeated word sequences by recompression.

A window is ``size`` consecutive words of one text. Every word covered by a
window whose word sequence also starts anywhere else (same text included) is
removed; windows are judged on the input.

Recompression names a text bottom-up. Each round names runs of one symbol and
then the pairs whose left symbol falls on side 0 and whose right symbol on side
1 of a pseudo-random split. Names are hashes of what they stand for, so all
tasks give equal strings equal names without an exchange. For every symbol the
words that its parse depended on (itself and the neighbours that decided
borders) are tracked: a symbol whose span of dependence lies inside a window is
an interior symbol of that window and occurs wherever the window occurs.

Spark rounds:

1. every window elects one interior symbol (the smallest key; a window without
   one elects itself); elected symbols are counted over the whole corpus;
2. symbols that are shared become a bitmap filter of bounded size; windows that
   elected a shared symbol are counted by a 128-bit hash of their words. A window that
   occurs once reports its own place; no window rows are joined;
3. each text meets the list of its reported windows and drops the words that
   the other candidate windows cover.

The filter has no false negatives, and its false positives only add rows to the
exact count of round 2, so results do not depend on its size. Counts combine map-side,
so a passage in a third of all texts is one partial row per task.

Defined results: a null, empty or short text has no window and keeps its words;
repeated rows repeat each other's windows; other columns are ignored; rows are
told apart by id and text. Work is linear in the text length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import map_texts, sha256, shared_table, utf8
from fleetspark.llm.hashing import U, Ranges, Words, mix

#: Rounds of pair naming, and those before which runs are named too.
ROUNDS = 5
RUN_ROUNDS = (0, 2)
#: Filter bits per shared symbol (two are set), and the most bits a filter has (32 MB).
FILTER_BITS = 16
MAX_FILTER_BITS = 1 << 28


class Symbols:
    """Symbols of the last round that depend on the words ``lo:hi`` of one text only."""

    def __init__(self, words: Words, size: int, rounds: int = ROUNDS):
        n, doc = len(words.hash), words.text_of()
        first, last = words.first[:-1], words.first[1:]
        name, lo = words.hash, np.arange(n)
        hi = lo + 1
        for r in range(rounds):
            if r in RUN_ROUNDS and len(name):
                name, lo, hi, doc = self._runs(name, lo, hi, doc, first, last)
            name, lo, hi, doc = self._pairs(name, lo, hi, doc, first, last, r)
        inside = (hi - lo <= size) & (lo >= first[doc]) & (hi <= last[doc]) if n else np.zeros(0, bool)
        self.lo, self.hi, self.name = lo[inside], hi[inside], name[inside]

    @staticmethod
    def _around(lo, hi, doc, first, last):
        """For each symbol: where its left neighbour's dependence starts and its right neighbour's ends."""
        left, right = first[doc] - 1, last[doc] + 1
        same = doc[1:] == doc[:-1]
        left[1:] = np.where(same, lo[:-1], left[1:])
        right[:-1] = np.where(same, hi[1:], right[:-1])
        return left, right

    @classmethod
    def _runs(cls, name, lo, hi, doc, first, last):
        left, right = cls._around(lo, hi, doc, first, last)
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        s = np.flatnonzero(new)
        e = np.append(s[1:], len(name)) - 1
        n = (e - s + 1).astype(U)
        named = np.where(n > 1, mix(name[s] ^ mix(n * U(0x9E3779B97F4A7C15))), name[s])
        return named, left[s], right[e], doc[s]

    @classmethod
    def _pairs(cls, name, lo, hi, doc, first, last, r):
        if not len(name):
            return name, lo, hi, doc
        left, right = cls._around(lo, hi, doc, first, last)
        side = (mix(name + U(1000 + r)) >> U(63)).astype(bool)
        opens = np.zeros(len(name), bool)
        opens[:-1] = ~side[:-1] & side[1:] & (doc[1:] == doc[:-1])
        closes = np.zeros(len(name), bool)
        closes[1:] = opens[:-1]
        lo = np.where(side & ~closes, left, lo)
        hi = np.where(~side & ~opens, right, hi)
        i = np.flatnonzero(~closes)
        j = i + opens[i]
        named = np.where(opens[i], mix(name[i] * U(3) + mix(name[j])), name[i])
        return named, lo[i], hi[j], doc[i]


class Windows:
    """All windows of a batch of texts: ``start`` (word index), ``text`` and the key each elects."""

    def __init__(self, raws: list[bytes], size: int):
        self.words = words = Words(raws)
        n, doc = len(words.hash), words.text_of()
        start = np.arange(max(0, n - size + 1))
        self.start = start[doc[start] == doc[start + size - 1]] if len(start) else start
        self.text, self.size = doc[self.start], size
        self.ranges = Ranges(words.hash)
        symbols = Symbols(words, size)
        keys = mix(symbols.name ^ self.ranges.hashes(symbols.lo, symbols.hi))
        # interior symbols of the window at s: those with lo >= s and hi <= s + size, a contiguous range
        begin = np.cumsum(np.bincount(symbols.lo + 1, minlength=n + 2))[self.start]
        end = np.cumsum(np.bincount(symbols.hi, minlength=n + 2))[self.start + size]
        self.elected = self._smallest(keys, begin, end)
        loose = self.elected < 0
        self.key = np.empty(len(self.start), U)
        self.key[~loose] = keys[self.elected[~loose]]
        alone = self.start[loose]
        self.key[loose] = mix(self.ranges.hashes(alone, alone + size) + U(5))

    @staticmethod
    def _smallest(keys, begin, end):
        """Index of the smallest key in each range (-1: empty), by doubling blocks."""
        out = np.full(len(begin), -1)
        n = end - begin
        best, width = np.arange(len(keys)), 1
        while width <= n.max(initial=0):
            at = np.flatnonzero((n >= width) & (n < 2 * width))
            a, b = best[begin[at]], best[end[at] - width]
            out[at] = np.where(keys[a] <= keys[b], a, b)
            a, b = best[:-width], best[width:]
            best, width = np.where(keys[a] <= keys[b], a, b), 2 * width
        return out

    def occurrences(self) -> np.ndarray:
        """One key per elected symbol place (windows that elect the same place count once)."""
        symbol = self.elected >= 0
        _, one = np.unique(self.elected[symbol], return_index=True)
        return np.concatenate([self.key[symbol][one], self.key[~symbol]])

    def candidates(self, shared: Filter) -> np.ndarray:
        return np.flatnonzero(shared.has(self.key))

    def place(self, chosen: np.ndarray) -> np.ndarray:
        """Start of the windows within their texts."""
        return self.start[chosen] - self.words.first[self.text[chosen]]


class Filter:
    """Bitmap of 64-bit keys with two bits each; never misses a key it was given."""

    def __init__(self, bits: int, blocks: np.ndarray, values: np.ndarray):
        self.bits, self.bitmap = bits, np.zeros(max(1, bits >> 6), U)
        self.bitmap[blocks] = values

    @classmethod
    def of(cls, keys: DataFrame) -> Filter:
        """Filter of a column ``key``, sized by its count; Spark combines its 64-bit blocks."""
        bits = 1 << 16
        n = keys.count()
        while bits < FILTER_BITS * n and bits < MAX_FILTER_BITS:
            bits <<= 1
        at = [F.expr(f"shiftrightunsigned(key, {shift}) & {bits - 1}L") for shift in (0, 32)]
        ones = keys.select(F.explode(F.array(*at)).alias("at"))
        blocks = (ones.groupBy(F.expr("cast(shiftright(at, 6) as int)").alias("block"))
                      .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("value")).toArrow())
        return cls(bits, blocks["block"].to_numpy(), blocks["value"].to_numpy().view(U))

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for shift in (0, 32):
            at = (keys >> U(shift)) & U(min(self.bits, 1 << 32) - 1)
            found &= (self.bitmap[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1) == 1
        return found


def _shared_filter(keys: DataFrame) -> Filter:
    """Filter of the keys that occur twice or more."""
    shared = keys.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
    return Filter.of(shared_table(keys.sparkSession, shared, "symbols"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 35, with_text: bool = False) -> DataFrame:
    """One row per input row: the id, n_words, n_removed, kept_sha256 and optionally the kept text."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col), utf8(text_col).alias("raw"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"))

    def elect(part: pa.RecordBatch) -> dict:
        keys, n = np.unique(Windows(part.column("raw").to_pylist(), size).occurrences(), return_counts=True)
        return {"key": pa.array(keys.view(np.int64)), "n": pa.array(n, pa.int64())}

    shared = spark.sparkContext.broadcast(_shared_filter(map_texts(src.select("raw"), elect, "key long, n long")))

    def hashed(part: pa.RecordBatch) -> dict:
        w = Windows(part.column("raw").to_pylist(), size)
        chosen = w.candidates(shared.value)
        at = w.start[chosen]
        h = [w.ranges.hashes(at, at + size, k).view(np.int64) for k in (0, 1)]
        return {"h1": pa.array(h[0]), "h2": pa.array(h[1]), "row": pa.array(part.column("row").to_numpy()[w.text[chosen]]),
                "at": pa.array(w.place(chosen).astype(np.int32))}

    places = map_texts(src.select("raw", "row"), hashed, "h1 long, h2 long, row long, at int")
    single = (places.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("row").alias("row"), F.min("at").alias("at"))
                    .where("n = 1").groupBy("row").agg(F.collect_list("at").alias("single")))

    def cut(part: pa.RecordBatch) -> dict:
        raws = part.column("raw").to_pylist()
        w = Windows(raws, size)
        chosen = w.candidates(shared.value)
        single = part.column("single")
        own = np.concatenate([np.empty(0, np.int64), *(np.asarray(x.as_py(), np.int64) + w.words.first[i]
                                                       for i, x in enumerate(single) if x.is_valid)])
        repeated = w.start[chosen]
        repeated = repeated[~np.isin(repeated, own)]
        cover = np.zeros(len(w.words.hash) + 1, np.int64)
        np.add.at(cover, repeated, 1)
        np.add.at(cover, repeated + size, -1)
        kept = np.cumsum(cover[:-1]) == 0
        data = w.words.data.tobytes()
        out = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
        for a, b in zip(w.words.first[:-1], w.words.first[1:]):
            mine = np.flatnonzero(kept[a:b]) + a
            text = b" ".join([data[i:j] for i, j in zip(w.words.start[mine].tolist(), w.words.stop[mine].tolist())])
            out["n_words"].append(b - a)
            out["n_removed"].append(b - a - len(mine))
            out["kept_sha256"].append(sha256(text))
            out["kept"].append(text.decode("utf-8", "replace") if with_text else None)
        found = {id_col: part.column(id_col), "n_words": pa.array(out["n_words"], pa.int64()),
                 "n_removed": pa.array(out["n_removed"], pa.int64()), "kept_sha256": pa.array(out["kept_sha256"], pa.string())}
        return found | ({"kept": pa.array(out["kept"], pa.string())} if with_text else {})

    schema = f"`{id_col}` {id_type}, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")
    return map_texts(src.join(single, "row", "left").select(id_col, "raw", "single"), cut, schema)
