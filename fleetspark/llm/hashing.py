"""Vectorised hashing of words and word windows over the bytes of many texts at once.

A word's hash reads it in blocks of 8 bytes through a non-linear mix (long words
by BLAKE2b), so that no family of words collides as it does under a polynomial modulo 2^64.
Ranges of words are polynomials modulo 2^64 with odd multipliers over these
hashes; positions are removed by multiplying with powers of the multiplier's
inverse. All hashes are the same in every task.
"""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Powers:
    """Powers of an odd multiplier and of its inverse, grown on demand."""

    def __init__(self, multiplier: int):
        self.base, self.inverse = U(multiplier), U(pow(multiplier, -1, 1 << 64))
        self.up = self.down = np.ones(1, U)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, b, U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


_WINDOWS = (Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5))
#: Words up to this many bytes are hashed together, block by block; longer ones each on its own.
SHORT = 64
#: White space of the word rule `[^\x20\x09-\x0D]+`.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _prefix(values: np.ndarray, powers: Powers) -> np.ndarray:
    powers.need(len(values) + 1)
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers.up[:len(values)], out=out[1:])
    return out


def hash_words(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hash of each word ``data[start:stop]``."""
    size = stop - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    block_at = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the 8 bytes from every place on
    out = mix(size.astype(U) * U(0x9E3779B97F4A7C15) + U(17))
    live = np.flatnonzero(size <= SHORT)
    for at in range(0, SHORT, 8):
        live = live[size[live] > at]
        if not len(live):
            break
        block = block_at[start[live] + at]
        unused = np.maximum(8 - (size[live] - at), 0).astype(U) * U(8)
        out[live] = mix((out[live] ^ ((block << unused) >> unused)) * U(0xD6E8FEB86659FD93) + U(0x2545F4914F6CDD1D))
    for i in np.flatnonzero(size > SHORT).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i]:stop[i]].tobytes(), digest_size=8).digest(), "little")
    return out


class Words:
    """Words of a list of texts: ``hash`` per word, byte ``start``/``stop`` in ``data``, ``first`` word of each text."""

    def __init__(self, raws: list[bytes], space: np.ndarray = SPACE):
        self.data = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
        inside = ~space[self.data]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        self.start, self.stop = edge[0::2], edge[1::2]
        begins = np.cumsum([0] + [len(r) + 1 for r in raws])
        self.first = np.searchsorted(self.start, begins)
        self.hash = hash_words(self.data, self.start, self.stop)

    def text_of(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class Ranges:
    """128-bit hashes of word ranges."""

    def __init__(self, words: np.ndarray):
        self.sums = [_prefix(words, p) for p in _WINDOWS]

    def hashes(self, start: np.ndarray, stop: np.ndarray, k: int = 0) -> np.ndarray:
        return mix((self.sums[k][stop] - self.sums[k][start]) * _WINDOWS[k].down[start])
