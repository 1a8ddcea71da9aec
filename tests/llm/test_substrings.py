import hashlib
import random
from collections import Counter

import pytest
from helpers import ODD_ROWS, WORD, data, frame

from fleetspark.llm import substrings as sub


def brute(rows, size):
    seen, cut = Counter(), [WORD.findall(t or "") for _, t, *_ in rows]
    for w in cut:
        seen.update(tuple(w[k:k + size]) for k in range(len(w) - size + 1))
    out = []
    for (i, *_), w in zip(rows, cut):
        gone = {k + j for k in range(len(w) - size + 1) if seen[tuple(w[k:k + size])] > 1 for j in range(size)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [3, 35])
def test_against_brute_force(spark, size):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice("ab" if i % 3 else "abcdefgh") for _ in range(rnd.randint(0, 120))), "x") for i in range(40)]
    rows += [(None, "a " * 80, "x"), (7, "a b " * 60, "x"), (7, "a b " * 60, "x"), (9, " \n".join(map(str, range(100))), "x"),
             (10, " ".join(map(str, range(20, 90))), "x"), *[r for r in ODD_ROWS if len(r[1] or "") < 20000]]
    got = data(sub.remove_repeats(frame(spark, rows).repartition(3), size=size), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute(rows, size)


def test_small_filter_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(sub, "MAX_FILTER_BITS", 1 << 16)
    rows = [(i, " ".join(f"w{(i * j) % 997}" for j in range(200)), "x") for i in range(60)] + [(1, " ".join(f"w{j % 997}" for j in range(200)), "x")]
    assert data(sub.remove_repeats(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute(rows, 35)
    assert sub.remove_repeats(frame(spark, [])).count() == 0


def test_words_that_collide_under_polynomials_stay_apart(spark):
    """Thue-Morse words and their complements have equal polynomial hashes modulo 2^64, whatever the multiplier."""
    rows = []
    for k, n in enumerate((1024, 2048, 4096)):
        one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
        other = one.translate(str.maketrans("ab", "ba"))
        words = [f"w{k}x{i}" for i in range(34)]
        rows += [(10 * k, " ".join([*words[:17], one, *words[17:]]), "x"), (10 * k + 1, " ".join([*words[:17], other, *words[17:]]), "x")]
    got = data(sub.remove_repeats(frame(spark, rows)), "doc_id", "n_removed")
    assert got == sorted(((i, 0) for i, _, _ in rows), key=str)


def test_word_hashes():
    import numpy as np

    from fleetspark.llm.hashing import hash_words

    words = [b"a" * n for n in range(1, 200)] + [b"ab", b"ba", b"a\x00", b"\x00a", b"\x00", b"\x00" * 8, b"\x00" * 9, b"abcdefgh", b"abcdefghi"]
    text = b"".join(words) + b"tail"
    stop = np.cumsum([len(w) for w in words])
    start = stop - np.array([len(w) for w in words])
    got = hash_words(np.frombuffer(text, np.uint8), start, stop)
    assert len(set(got.tolist())) == len(set(words))
    alone = [hash_words(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words]
    assert got.tolist() == [int(x) for x in alone]
