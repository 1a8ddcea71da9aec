"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Inputs: a word (run of bytes that are neither ASCII white space nor ASCII punctuation, A-Z
lower-cased) is the sum of a hashed word vector (zero for words that few training texts hold)
and the mean of its hashed character-trigram vectors. Two gated recurrent layers read a window in both
directions; attention weighs the states; the pooled state gives the logit.
Windows of ``WIDTH`` words start every ``STRIDE`` words, so they overlap and
cover the whole text. A document's score is that of its highest window.

Training (numpy, in one task) uses about ``TRAIN_TOXIC`` toxic and
``TRAIN_CLEAN`` other labelled rows (at most twice as many) outside the held-out
fold, chosen by a hash of the id, and at most ``TRAIN_WINDOWS`` windows of each. A toxic document
teaches through its highest window, a clean one through all its windows.

Defined results: a null, empty or wordless text scores 0; null ids belong to
the training fold but match no label; several labels of one id count as toxic
if any is; without labelled rows every text scores by the untrained network;
repeated rows each get their result. Labels, language, source and id are not
inputs of a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import hash_sample, map_arrow, map_texts, remainder, utf8
from fleetspark.llm.gru import Adam, gru_backward, gru_forward, sigmoid, sum_rows
from fleetspark.llm.hashing import U, Words, mix

WIDTH, STRIDE = 48, 36
STATE, VECTOR, ATTENTION = 12, 12, 8
WORD_ROWS, CHAR_ROWS = 1 << 14, 1 << 12
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_WINDOWS = 2000, 4000, 24
EPOCHS, BATCH, RATE = 4, 64, 0.01
#: Texts that a word must occur in to get a vector of its own, and the share of words whose vector is left out of a training step.
LEAST_TEXTS, DROP = 6, 0.25
#: Documents seen in training at least (small samples are gone over more often).
LEAST_SEEN = 12_000
THRESHOLD = 0.3
CHUNK = 4 << 20

_BREAK = np.zeros(256, bool)
_BREAK[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


class Inputs:
    """Distinct words of a batch of texts (hashed word row, hashed trigram rows) and the words of each text."""

    def __init__(self, raws: list[bytes]):
        words = Words([r.lower() for r in raws], _BREAK)
        h, at, self.word = np.unique(words.hash, return_index=True, return_inverse=True)
        self.first = words.first
        self.row = (h >> U(20)).astype(np.int64) % WORD_ROWS
        start, n = words.start[at], (words.stop - words.start)[at]
        # trigrams over "<word>": positions -1 .. n-2 of each distinct word
        of = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        data = words.data

        def byte(offset):
            place = k + offset
            return np.where((place >= 0) & (place < n[of]), data[np.clip(start[of] + place, 0, len(data) - 1)], 1).astype(U)

        gram = mix((byte(-1) << U(16)) | (byte(0) << U(8)) | byte(1))
        self.gram, self.gram_of, self.size = (gram >> U(20)).astype(np.int64) % CHAR_ROWS, of, np.maximum(n, 1)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Places (WIDTH x windows) of each window's words, -1 beyond the text, and the text of each window."""
        n = np.diff(self.first)
        many = np.where(n > 0, 1 + np.maximum(0, -(-(n - WIDTH) // STRIDE)), 0)
        text = np.repeat(np.arange(len(n)), many)
        k = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        place = (k * STRIDE)[None, :] + np.arange(WIDTH)[:, None]
        return np.where(place < n[text][None, :], place + self.first[:-1][text][None, :], -1), text


class Network:
    def __init__(self, seed: int = 1):
        rnd, f32 = np.random.default_rng(seed), np.float32
        self.weights = {
            "word": np.zeros((WORD_ROWS, VECTOR), f32), "char": rnd.normal(0, 0.1, (CHAR_ROWS, VECTOR)).astype(f32),
            "x": rnd.normal(0, 0.3, (VECTOR, 6 * STATE)).astype(f32), "b": np.zeros((1, 6 * STATE), f32),
            "u1": rnd.normal(0, 0.2, (STATE, 3 * STATE)).astype(f32), "u2": rnd.normal(0, 0.2, (STATE, 3 * STATE)).astype(f32),
            "a": rnd.normal(0, 0.3, (2 * STATE, ATTENTION)).astype(f32), "v": rnd.normal(0, 0.3, (ATTENTION, 1)).astype(f32),
            "o": rnd.normal(0, 0.3, (2 * STATE, 1)).astype(f32), "c": np.full((1, 1), -1.0, f32),
        }

    def vectors(self, x: Inputs) -> np.ndarray:
        """Vector of each distinct word, and a zero row for places beyond a text."""
        w = self.weights
        out = np.zeros((len(x.row) + 1, VECTOR), np.float32)
        if len(x.row):
            starts = np.cumsum(x.size) - x.size
            out[:-1] = w["word"][x.row] + np.add.reduceat(w["char"][x.gram], starts, axis=0) / x.size[:, None].astype(np.float32)
        return out

    def logits(self, projected: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logit of each window; ``ids`` (WIDTH, B) are rows of ``projected``, the last row standing for none."""
        w, none = self.weights, len(projected) - 1
        real = ids != none
        p = projected[ids]
        f = gru_forward(p[:, :, :3 * STATE], w["u1"], np.zeros((ids.shape[1], STATE), np.float32), keep=keep)
        # backwards; leading places beyond the text restart the state
        rev = ids[::-1]
        fresh = np.zeros(rev.shape, bool)
        fresh[1:] = ~real[::-1][:-1]
        g = gru_forward(p[::-1, :, 3 * STATE:], w["u2"], np.zeros((ids.shape[1], STATE), np.float32), fresh, keep=keep)
        (f, kept1), (g, kept2) = (f, g) if keep else ((f, None), (g, None))
        h = np.concatenate([f, g[::-1]], axis=2)
        t = np.tanh(h @ w["a"])
        s = np.where(real, (t @ w["v"])[:, :, 0], np.float32(-30))
        e = np.exp(s - s.max(axis=0))
        share = e / e.sum(axis=0)
        pooled = (share[:, :, None] * h).sum(axis=0)
        out = (pooled @ w["o"])[:, 0] + w["c"][0, 0]
        return (out, (kept1, kept2, fresh, h, t, share, pooled)) if keep else out

    def gradients(self, x: Inputs, vectors: np.ndarray, ids: np.ndarray, kept: tuple, d_out: np.ndarray, left: np.ndarray) -> dict:
        w = self.weights
        kept1, kept2, fresh, h, t, share, pooled = kept
        g = {"o": pooled.T @ d_out[:, None], "c": d_out.sum().reshape(1, 1)}
        d_pooled = d_out[:, None] * w["o"][:, 0][None, :]
        d_h = share[:, :, None] * d_pooled[None]
        d_share = (h * d_pooled[None]).sum(axis=2)
        d_s = share * (d_share - (share * d_share).sum(axis=0))
        d_t = d_s[:, :, None] * w["v"][:, 0] * (1 - t * t)
        g["v"] = (t * d_s[:, :, None]).sum(axis=(0, 1))[:, None]
        flat = lambda m: m.reshape(-1, m.shape[-1])
        g["a"] = flat(h).T @ flat(d_t)
        d_h = d_h + d_t @ w["a"].T
        d1, g["u1"] = gru_backward(d_h[:, :, :STATE], w["u1"], kept1)
        d2, g["u2"] = gru_backward(d_h[::-1, :, STATE:], w["u2"], kept2, fresh)
        d_p = sum_rows(ids.ravel(), flat(np.concatenate([d1, d2[::-1]], axis=2)), len(vectors))
        g["x"], g["b"] = vectors.T @ d_p, d_p.sum(axis=0, keepdims=True)
        d_vec = (d_p @ w["x"].T * left)[:-1]
        g["word"] = sum_rows(x.row, d_vec, WORD_ROWS)
        g["char"] = sum_rows(x.gram, (d_vec / x.size[:, None].astype(np.float32))[x.gram_of], CHAR_ROWS)
        return g

    def window_logits(self, x: Inputs, places: np.ndarray) -> np.ndarray:
        vectors = self.vectors(x)
        projected = vectors @ self.weights["x"] + self.weights["b"]
        ids = np.where(places >= 0, x.word[places] if len(x.word) else 0, len(x.row))
        return np.concatenate([np.empty(0, np.float32), *(self.logits(projected, ids[:, i:i + 2048]) for i in range(0, ids.shape[1], 2048))])

    def fit(self, raws: list[bytes], toxic: np.ndarray) -> None:
        if not len(raws) or toxic.min() == toxic.max():
            return
        optimizer = Adam(self.weights, RATE)
        rnd = np.random.default_rng(2)
        epochs = max(EPOCHS, LEAST_SEEN // len(raws))
        texts = np.zeros(WORD_ROWS, np.int64)
        for raw in raws:
            texts[np.unique(Inputs([raw]).row)] += 1
        common = texts >= LEAST_TEXTS
        for epoch in range(epochs):
            optimizer.rate = RATE * (1 - 0.9 * epoch / epochs)
            order = rnd.permutation(len(raws))
            for k in range(0, len(order), BATCH):
                mine = order[k:k + BATCH]
                x = Inputs([raws[i] for i in mine])
                places, text = x.windows()
                if not len(text):
                    continue
                # a bounded number of windows of each text
                draw = rnd.random(len(text))
                by = np.lexsort((draw, text))
                rank = np.empty(len(text), int)
                rank[by] = np.arange(len(text)) - np.searchsorted(text[by], text[by])
                chosen = np.flatnonzero(rank < TRAIN_WINDOWS)
                places, text = places[:, chosen], text[chosen]
                left = ((rnd.random(len(x.row) + 1) >= DROP) / (1 - DROP)).astype(np.float32)[:, None]
                vectors = self.vectors(x) * left
                projected = vectors @ self.weights["x"] + self.weights["b"]
                ids = np.where(places >= 0, x.word[places], len(x.row))
                logit, kept = self.logits(projected, ids, keep=True)
                y = toxic[mine][text]
                high = np.full(len(mine), -np.inf, np.float32)
                np.maximum.at(high, text, logit)
                top = logit == high[text]
                n = np.bincount(text, minlength=len(mine))[text]
                d = np.where(y > 0, (sigmoid(logit) - 1) * top, sigmoid(logit) * np.where(top, 0.5 + 0.5 / n, 0.5 / n))
                g = self.gradients(x, vectors, ids, kept, (d / len(mine)).astype(np.float32), left)
                g["word"][~common] = 0
                optimizer.step(g)


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> Network:
    """Fit on a bounded sample of labelled rows; the texts never pass through the driver."""
    spark = docs.sparkSession
    marks = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    marks = marks.withColumn("draw", F.xxhash64(id_col, F.lit("draw")))
    total = {bool(r["bad"]): r["count"] for r in marks.groupBy((F.col("toxic") == 1).alias("bad")).count().collect()}
    picked = hash_sample(marks.where("toxic = 1"), F.col("draw"), TRAIN_TOXIC, total.get(True, 0)).union(
        hash_sample(marks.where("toxic <> 1"), F.col("draw"), TRAIN_CLEAN, total.get(False, 0)))
    # at most twice TRAIN_TOXIC + TRAIN_CLEAN ids, so the broadcast is bounded
    sample = (docs.select(F.col(id_col).alias("picked_id"), utf8(text_col).alias("raw"))
                  .join(F.broadcast(picked.select(F.col(id_col).alias("picked_id"), "toxic", "draw")), "picked_id")
                  .dropDuplicates(["picked_id"]).select("draw", "raw", "toxic"))

    def fit(batches):
        rows = [x for b in batches for x in zip(*(b.column(c).to_pylist() for c in ("draw", "raw", "toxic")))]
        net = Network()
        rows.sort(key=lambda x: x[0])
        net.fit([x[1] for x in rows], np.array([x[2] for x in rows], np.float32))
        yield pa.RecordBatch.from_pydict({"name": pa.array(list(net.weights)), "weights": pa.array([v.tobytes() for v in net.weights.values()], pa.binary())})

    net = Network()
    for row in map_arrow(sample.repartition(1), fit, "name string, weights binary").collect():
        net.weights[row["name"]] = np.frombuffer(row["weights"], np.float32).reshape(net.weights[row["name"]].shape).copy()
    return net


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, held_fold: int = 2) -> DataFrame:
    """One row per input row: id, held_out, score, predicted, n_windows."""
    outside = F.coalesce(remainder(id_col, folds) != held_fold, F.lit(True))
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels.where(outside), id_col, text_col))
    src = docs.select(F.col(id_col), F.coalesce(remainder(id_col, folds) == held_fold, F.lit(False)).alias("held_out"), utf8(text_col).alias("raw"))

    def step(part: pa.RecordBatch) -> dict:
        x = Inputs(part.column("raw").to_pylist())
        places, text = x.windows()
        score = np.zeros(part.num_rows)
        np.maximum.at(score, text, sigmoid(shared.value.window_logits(x, places).astype(np.float64)))
        return {id_col: part.column(id_col), "held_out": part.column("held_out"), "score": pa.array(score),
                "predicted": pa.array((score >= THRESHOLD).astype(np.int32)), "n_windows": pa.array(np.bincount(text, minlength=len(score)).astype(np.int64))}

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, held_out boolean, score double, predicted int, n_windows long"
    return map_texts(src, step, schema, limit=CHUNK)
