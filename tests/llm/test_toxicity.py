import random
import zlib

import numpy as np
from helpers import ODD_ROWS, frame

from fleetspark.llm import toxicity as tx


def corpus(n):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        w = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6))) for _ in range(rnd.randint(5, 150))]
        toxic = i % 3 == 0
        for _ in range(3 if toxic else 0):
            w[rnd.randrange(len(w))] = rnd.choice(["zorgal", "mukkit", "frazzle"])
        rows.append((i, " ".join(w), "en", int(toxic)))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus(400)
    labels = spark.createDataFrame([(i, y) for i, _, _, y in rows] + [(0, None), (None, 1), (0, 1)], "doc_id long, toxic int")
    odd = [(None if i is None else 1000 + i, t, x) for i, t, x in ODD_ROWS]
    got = tx.score_toxicity(frame(spark, [r[:3] for r in rows] + odd), labels).collect()
    assert len(got) == len(rows) + len(odd)
    y = {i: t for i, _, _, t in rows}
    held = [(r["score"], y[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in y]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum((s >= tx.THRESHOLD) == bool(t) for s, t in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= tx.THRESHOLD) for r in got)
    assert all(r["score"] == 0 for r in got if r["n_windows"] == 0)
    # labels of the held-out fold are not learned from
    other = spark.createDataFrame([(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, _, _, t in rows], "doc_id long, toxic int")
    again = {r["doc_id"]: r["score"] for r in tx.score_toxicity(frame(spark, [r[:3] for r in rows]), other).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-6 for r in got if r["doc_id"] in y)


def test_windows_cover_every_word():
    for n in (0, 1, tx.WIDTH, tx.WIDTH + 1, tx.WIDTH + tx.STRIDE, 500):
        x = tx.Inputs([b" ".join(b"w%d" % i for i in range(n)), b"", b"tail"])
        places, text = x.windows()
        assert set(places[places >= 0].ravel()) == set(range(n + 1))
        assert list(np.unique(text)) == ([0, 2] if n else [2])


def test_gradients_match_differences():
    net = tx.Network()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    x = tx.Inputs([b"aa bb cc dd", b"ee ff"])
    places, _ = x.windows()
    ids = np.where(places >= 0, x.word[places], len(x.row))

    def value():
        v = net.vectors(x)
        return float(net.logits(v @ net.weights["x"] + net.weights["b"], ids).sum())

    v = net.vectors(x)
    _, kept = net.logits(v @ net.weights["x"] + net.weights["b"], ids, keep=True)
    g = net.gradients(x, v, ids, kept, np.ones(ids.shape[1]), np.ones((len(v), 1), np.float32))
    for name in ("x", "u1", "u2", "a", "v", "o", "b"):
        w = net.weights[name]
        at = np.unravel_index(np.argmax(np.abs(g[name])), w.shape)
        old = w[at]
        w[at] = old + 1e-2
        up = value()
        w[at] = old - 1e-2
        down = value()
        w[at] = old
        assert abs((up - down) / 2e-2 - g[name][at]) < 1e-2 * max(0.05, abs(g[name][at])), name


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert tx.score_toxicity(frame(spark, []), none).count() == 0
    assert tx.score_toxicity(frame(spark, [(1, "a b", "x")]), none).count() == 1
