import random

import public_tokenizers as tok
import pytest
from helpers import ODD_ROWS, SF, data, frame
from tokenizers import Tokenizer

from fleetspark.llm import token_counts as tc

PATH = tok.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def coder():
    return tc.TokenCounter(*tc.rules_of(PATH))


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def _texts(coder, n, most, seed):
    rnd = random.Random(seed)
    letters = "abeinrst aeiou  th\n1'2é漢aaaa😀#\t're'll   \u0085　" + "".join(sorted(coder.rules.odd)[:40])
    for _ in range(n):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, most)))
        if rnd.random() < 0.3:
            k = rnd.randint(0, len(text))
            text = text[:k] + "<|endoftext|>" * rnd.randint(1, 2) + text[k:]
        yield text


def test_counts_equal_the_library(coder, library):
    for text in _texts(coder, 4000, 60, 1):
        assert coder.count(text) == library(text), repr(text)


def test_every_character_is_cut_as_the_library_does(coder, library):
    odd = sorted(coder.rules.odd)
    assert odd, "the regex module and the library know the same Unicode: the exact pattern is not exercised"
    for c in odd[:: max(1, len(odd) // 2000)]:
        text = f"a{c}{c} {c}1{c}a  {c}"
        assert coder.count(text) == library(text), repr(text)


def test_every_prefix_equals_the_library(coder, library):
    for text in _texts(coder, 500, 25, 2):
        table, want = tc.PrefixTable(coder, text), [library(text[:p]) for p in range(len(text) + 1)]
        assert table.every().tolist() == want and [table.at(p) for p in range(len(text) + 1)] == want, repr(text)
        for budget in (0, 1, 5):
            assert table.cut_for(budget) == max(p for p, n in enumerate(want) if n <= budget)


def test_long_pieces_and_memo_turnover(coder, library, monkeypatch):
    for text in ("a" * 30000, " " * 5000 + "x", "é" * 3000 + "\n" * 2000, "ab" * 25, "!" * 41):
        assert coder.count(text) == library(text)
    small = tc.TokenCounter(*tc.rules_of(PATH))
    monkeypatch.setattr(tc, "MEMO_PIECES", 5)
    for text in _texts(small, 300, 40, 3):
        assert small.count(text) == library(text)


def test_operator(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = ODD_ROWS + [tuple(r) for r in docs.collect()] + [(7, "so <|endoftext|> it", "x")]
    extra = "n_bytes string, n_tokens string, over_limit string, raw string"
    got = data(tc.count_tokens(frame(spark, rows, extra), PATH), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = [(i, len((t or "").encode()), library(t or ""), library(t or "") > 512) for i, t, _ in rows]
    assert got == sorted(want, key=str)
    assert tc.count_tokens(frame(spark, []), PATH).count() == 0


def test_operator_answers_budgets(spark, library):
    rows = [(1, "It's  a small text, cut here.", "x"), (2, None, "x")]
    got = {r.doc_id: r for r in tc.count_tokens(frame(spark, rows), PATH, budgets=(0, 4, 100), prefixes=True).collect()}
    text = rows[0][1]
    assert got[1].prefix_tokens == [library(text[:p]) for p in range(len(text) + 1)]
    assert got[1].budget_chars == [max(p for p in range(len(text) + 1) if library(text[:p]) <= b) for b in (0, 4, 100)]
    assert (got[2].n_tokens, got[2].prefix_tokens, got[2].budget_chars) == (0, [0], [0, 0, 0])
