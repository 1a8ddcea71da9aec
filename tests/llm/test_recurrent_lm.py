import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import ODD_ROWS, SF, frame

from fleetspark.llm import recurrent_lm as lm
from fleetspark.llm.gru import gru_backward, gru_forward


def brute(rows):
    tokens = [(t or "").encode().lower().split() + ["END"] for _, t, *_ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in rows]
    counts = Counter(x for w, h in zip(tokens, held) if not h for x in w)
    total, distinct = sum(counts.values()), len(counts)
    bottom = math.log10(total + 0.5 * (distinct + 1))
    return [(i, h, len(w), sum(x in counts for x in w), total, sum(math.log10(counts.get(x, 0) + 0.5) - bottom for x in w))
            for (i, *_), w, h in zip(rows, tokens, held)]


@pytest.mark.parametrize("head", [lm.HEAD, 300])
def test_base_and_model_scores(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()] + ODD_ROWS
    got = sorted((tuple(r) for r in lm.score_documents(frame(spark, rows)).collect()), key=str)
    want = sorted(brute(rows), key=str)
    for g, w in zip(sorted(got, key=lambda x: (str(x[0]), x[2], x[5])), sorted(want, key=lambda x: (str(x[0]), x[2], x[5]))):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) <= 1e-6 * max(1, abs(w[5])) and math.isfinite(g[6]) and g[6] < 0
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)


def test_empty_tables(spark):
    assert lm.score_documents(frame(spark, [])).count() == 0
    only_held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = lm.score_documents(frame(spark, [(only_held, "a b", "x")])).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and math.isfinite(row["score"])


def network(n=40):
    return lm.Network(np.random.default_rng(3).random(n) + 0.1, seed=2)


def test_output_is_a_distribution():
    net = network()
    h = np.random.default_rng(4).normal(size=(1, lm.STATE)).astype(np.float32)
    logs = net.output(np.repeat(h, 40, axis=0), np.arange(40))
    assert abs(np.exp(logs.astype(float)).sum() - 1) < 1e-4


def test_state_is_carried_over_windows():
    net, rnd = network(), np.random.default_rng(5)
    texts = [np.append(rnd.integers(1, 40, n), 0) for n in (0, 3, 31, 32, 33, 200)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = net.score(np.concatenate(texts), bounds)
    for t, score in zip(texts, got):
        h, total = np.zeros((1, lm.STATE), np.float32), 0.0
        for before, now in zip([0, *t[:-1]], t):
            h = gru_forward(net.weights["x"][[[before]]], net.weights["u"], h)[0]
            total += float(net.output(h, np.array([now]))[0])
        assert abs(total - score) < 1e-3 * max(1, abs(total))


def test_gradients_match_differences():
    net, rnd = network(12), np.random.default_rng(6)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    x, y = rnd.integers(0, 12, (5, 3)), rnd.integers(0, 12, (5, 3))

    def loss():
        states = gru_forward(net.weights["x"][x], net.weights["u"], np.zeros((3, lm.STATE), np.float32), x == 0)
        return -net.output(states.reshape(-1, lm.STATE), y.ravel()).astype(float).mean()

    states, kept = gru_forward(net.weights["x"][x], net.weights["u"], np.zeros((3, lm.STATE), np.float32), x == 0, keep=True)
    g: dict = {}
    _, d = net.output(states.reshape(-1, lm.STATE), y.ravel(), g)
    _, g["u"] = gru_backward(d.reshape(states.shape), net.weights["u"], kept, x == 0)
    for name in ("u", "wc", "wo", "bo"):
        w = net.weights[name]
        at = tuple(s // 2 for s in w.shape)
        old = w[at]
        w[at] = old + 1e-2
        up = loss()
        w[at] = old - 1e-2
        down = loss()
        w[at] = old
        assert abs((up - down) / 2e-2 - g[name][at]) < 2e-4, name


def test_large_logits_give_the_same_shares():
    net = network()
    h = np.tanh(np.random.default_rng(4).normal(size=(50, lm.STATE))).astype(np.float32)
    target = np.arange(50) % 40
    plain = net.output(h, target)
    net.weights["bo"] = net.weights["bo"] + np.float32(lm.SAFE_LOGIT + 20)  # a shift of all logits changes no share
    assert np.allclose(net.output(h, target), plain, atol=1e-3)


def test_every_token_is_trained_on():
    ids = np.random.default_rng(7).integers(1, 40, 4 * lm.STEPS * 3 + 2)  # three lanes, two tokens over
    for at in (len(ids) - 1, len(ids) - 2):
        other = ids.copy()
        other[at] = ids[at] % 39 + 1
        a, b = network(), network()
        a.train(ids, lm.Adam(a.weights, 0.01))
        b.train(other, lm.Adam(b.weights, 0.01))
        assert not np.array_equal(a.flat(), b.flat()), at


def test_a_long_text_among_short_ones_takes_memory_by_its_tokens():
    net, rnd = network(), np.random.default_rng(8)
    texts = [np.append(rnd.integers(1, 40, 60_000), 0)] + [np.array([0])] * 600
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    tracemalloc.start()
    got = net.score(np.concatenate(texts), bounds)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
    assert np.allclose(got[1:], got[1]) and abs(got[0] - net.score(texts[0], np.array([0, len(texts[0])]))[0]) < 1e-3 * abs(got[0])


def test_head_look_up():
    rnd = np.random.default_rng(9)
    near = (lm.U(5) << lm.U(64 - lm.HEAD_BITS)) + np.arange(40, dtype=lm.U) * lm.U(3)  # forty words of equal leading bits
    word = np.unique(np.concatenate([rnd.integers(0, 1 << 63, 5000).astype(lm.U) * lm.U(2), near, np.array([1, (1 << 64) - 1], lm.U)]))
    lex = lm.Lexicon(word, np.ones(len(word), int), 0, 0, np.zeros(1), np.zeros(1), np.full(len(word), -1), 1, np.ones(1))
    asked = np.concatenate([word, word + lm.U(1), rnd.integers(0, 1 << 63, 5000).astype(lm.U)])
    place = {w: i for i, w in enumerate(word.tolist())}
    assert lex.look_up(asked).tolist() == [place.get(w, -1) for w in asked.tolist()]
    assert lm.Lexicon(word[:0], word[:0], 0, 0, np.zeros(1), np.zeros(1), word[:0], 1, np.ones(1)).look_up(asked).max() == -1
