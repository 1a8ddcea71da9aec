"""Byte-level BPE by prefix dynamic programming.

A token sequence is the BPE encoding of its bytes exactly when each token
encodes to itself and each neighbouring pair is compatible, that is, no merge
across the border wins against the merges that build the two tokens. Every
byte prefix therefore has one valid last token: the token that ends there and
is compatible with the last token of the prefix before it. Storing these last
tokens (``PrefixState``) makes appends exact (old entries never change) and
lets an edit re-encode only from the edit to the point where the stored states
agree again.

Texts are cut by the tokenizer's pattern first, each piece on its own. Pieces
repeat, so a task keeps a bounded memo of encoded pieces. The pieces of a batch that it lacks are
encoded in byte order: each keeps the states of the prefix it shares with the one before and appends the rest.

Defined results: a null text counts as empty (no ids, digests of the empty
string); a byte sequence that is not UTF-8 is read with replacement characters;
repeated rows give repeated results; other columns are ignored. A piece of n bytes takes O(n)
steps, so very long texts and words need no special case.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import map_texts, sha256, utf8

#: Entries of one generation of a task's memo.
MEMO_ENTRIES = 200_000
#: Pieces up to this many bytes look their substrings up; longer ones are read by the automaton.
SHORT = 64
_NEVER = 1 << 60


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of ``base64 rank`` lines."""
    found = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                found[int(rank)] = base64.b64decode(token)
    return [found[i] for i in range(len(found))]


class Memo:
    """Bounded memo of two generations: when the young one is full it becomes the old one, and entries
    of the old one that are asked for move on, so frequent entries stay."""

    def __init__(self, entries: int = MEMO_ENTRIES):
        self.entries = entries
        self.clear()

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.entries:
            self.young, self.old = {}, self.young
        self.young[key] = value


class Vocabulary:
    """Ranks with what the border test needs: for each token its two parts."""

    def __init__(self, tokens: list[bytes]):
        import ahocorasick

        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.reach = max(map(len, tokens))
        self.left = [-1] * len(tokens)
        self.right = [-1] * len(tokens)
        for i, t in enumerate(tokens):
            if len(t) > 1:
                parts = self._merged(t, i)
                if len(parts) == 2:
                    self.left[i], self.right[i] = parts
        self.ends = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            self.ends.add_word(t.decode("latin-1"), (i, len(t)))
        self.ends.make_automaton()
        self.pairs, self.pieces = Memo(), Memo()

    def _merged(self, data: bytes, below: int = _NEVER) -> list[int]:
        """Plain merging with ranks under ``below``: sets up the parts of short tokens."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
            low = min(ranks)
            if low >= below or low == _NEVER:
                break
            k = ranks.index(low)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, first: int, second: int) -> bool:
        """Whether the encoding of the two tokens' bytes is these two tokens.

        At the border stand, in time order, the tokens of the right edge of
        ``first`` and of the left edge of ``second``. A merge over the border
        wins if its rank comes before both neighbours' next merges (the left
        neighbour's next merge lies further left and wins a tie)."""
        right_edge, left_edge = [first], [second]
        while self.right[right_edge[-1]] >= 0:
            right_edge.append(self.right[right_edge[-1]])
        while self.left[left_edge[-1]] >= 0:
            left_edge.append(self.left[left_edge[-1]])
        i, j = len(right_edge) - 1, len(left_edge) - 1
        while True:
            next_left = right_edge[i - 1] if i else _NEVER
            next_right = left_edge[j - 1] if j else _NEVER
            over = self.ranks.get(self.tokens[right_edge[i]] + self.tokens[left_edge[j]], _NEVER)
            if over < next_left and over <= next_right and over < _NEVER:
                return False
            if not i and not j:
                return True
            if next_left <= next_right:
                i -= 1
            else:
                j -= 1

    def fits(self, first: int, second: int) -> bool:
        key = first << 32 | second
        known = self.pairs.get(key)
        if known is None:
            known = self.compatible(first, second)
            self.pairs.put(key, known)
        return known


class PrefixState:
    """Last token of every byte prefix of one piece; grows by exact appends."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        if data:
            self.append(data)

    def _extend(self, start: int) -> None:
        """Last tokens of the prefixes that end after ``start`` (those before are known).

        The automaton reports the tokens that end at a byte; the one that fits the prefix before it is unique."""
        v, last = self.vocabulary, self.last
        known, fits = v.pairs.get, v.fits
        if len(self.data) <= SHORT:
            self._extend_short(start)
            return
        reach = max(0, start - v.reach + 1)
        done = start
        for end, (token, n) in v.ends.iter(self.data[reach:].decode("latin-1")):
            end += reach + 1
            if end == done + 1:
                before = end - n
                if before:
                    key = last[before - 1] << 32 | token
                    ok = known(key)
                    if ok is None:
                        ok = fits(last[before - 1], token)
                    if not ok:
                        continue
                last.append(token)
                done = end
        if done != len(self.data):
            raise ValueError("the vocabulary lacks a byte")

    def _extend_short(self, start: int) -> None:
        """The same by looking up the substrings that end at each byte, short ones first: the valid token is mostly short."""
        v, data, last = self.vocabulary, self.data, self.last
        token_of, known, fits = v.ranks.get, v.pairs.young.get, v.fits
        for end in range(start + 1, len(data) + 1):
            for begin in range(end - 1, -1, -1):
                token = token_of(data[begin:end])
                if token is None:
                    continue
                if begin:
                    ok = known(last[begin - 1] << 32 | token)
                    if not (fits(last[begin - 1], token) if ok is None else ok):
                        continue
                last.append(token)
                break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def become(self, data: bytes) -> None:
        """Move on to other bytes, keeping the states of the common prefix."""
        same, most = 0, min(len(data), len(self.data))
        while same < most and data[same] == self.data[same]:
            same += 1
        self.data = data
        del self.last[same:]
        self._extend(same)

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        self._extend(start)

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Edit bytes ``start:stop``; states before the edit stay, and the old
        tail is taken over from where a whole token's reach of states agrees."""
        v = self.vocabulary
        reach = v.reach
        tail, tail_last = self.data[stop:], self.last[stop:]
        self.data, self.last = self.data[:start], self.last[:start]
        self.append(new)
        done, step = 0, 4 * reach
        while done < len(tail):
            base = len(self.data)
            self.append(tail[done:done + step])
            fresh = self.last[base:]
            old = tail_last[done:done + step]
            done += len(fresh)
            if done >= 2 * reach and len(fresh) >= reach and fresh[-reach:] == old[-reach:]:
                self.data += tail[done:]
                self.last += tail_last[done:]
                return

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.tokens[token])
        return out[::-1]


class Codec:
    """Encodes and decodes whole texts with one vocabulary and cutting pattern."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex

        self.vocabulary = Vocabulary(tokens)
        self.pattern = regex.compile(pattern)

    def piece(self, piece: str) -> bytes:
        """Ids of one piece as little-endian unsigned 32-bit integers."""
        v = self.vocabulary
        known = v.pieces.get(piece)
        if known is None:
            data = piece.encode()
            whole = v.ranks.get(data)
            ids = [whole] if whole is not None else PrefixState(v, data).ids()
            known = np.asarray(ids, "<u4").tobytes()
            if len(piece) <= 64:
                v.pieces.put(piece, known)
        return known

    def learn(self, pieces: set[str]) -> None:
        """Encode the short pieces that the memo lacks, in byte order."""
        v = self.vocabulary
        state = PrefixState(v)
        for data, piece in sorted((p.encode(), p) for p in pieces if len(p) <= SHORT // 4 and v.pieces.get(p) is None):
            whole = v.ranks.get(data)
            if whole is None:
                state.become(data)
            v.pieces.put(piece, np.asarray([whole] if whole is not None else state.ids(), "<u4").tobytes())

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        cut = [self.pattern.findall(text) for text in texts]
        self.learn(set().union(*cut))
        known = self.vocabulary.pieces.young.get  # replaced when the generation changes, then found by piece()
        return [b"".join([known(p) or self.piece(p) for p in pieces]) for pieces in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple[int, str], Codec] = {}


def _codec(key: int, tokens: list[bytes], pattern: str) -> Codec:
    """One codec per worker process and vocabulary, so that its bounded memos live across tasks."""
    found = _CODECS.get((key, pattern))
    if found is None:
        _CODECS.clear()
        found = _CODECS[key, pattern] = Codec(tokens, pattern)
    return found


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens, digests of the ids and of the decoded bytes, optionally the ids."""
    spark = docs.sparkSession
    tokens = read_ranks(ranks_path)  # a published vocabulary of fixed size
    shared = spark.sparkContext.broadcast(tokens)
    key = hash((ranks_path, len(tokens)))
    src = docs.select(F.col(id_col), utf8(text_col).alias("raw"))

    def step(part: pa.RecordBatch) -> dict:
        codec = _codec(key, shared.value, pattern)
        n, ids_sha, text_sha, ids = [], [], [], []
        for coded in codec.encode_all([raw.decode("utf-8", "replace") for raw in part.column("raw").to_pylist()]):
            n.append(len(coded) // 4)
            ids_sha.append(sha256(coded))
            text_sha.append(sha256(codec.decode(coded)))
            if with_ids:
                ids.append(np.frombuffer(coded, "<u4").astype(np.int32))
        out = {id_col: part.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()),
               "decoded_sha256": pa.array(text_sha, pa.string())}
        return out | ({"ids": pa.array(ids, pa.list_(pa.int32()))} if with_ids else {})

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(src, step, schema + (", ids array<int>" if with_ids else ""))
