"""Gated recurrent language model with a class-factored softmax, for whole-document log-likelihoods.

Tokens are the lower-cased (A-Z) white-space words and one end per text. Spark
counts all training tokens. The network predicts ``VOCABULARY`` frequent words,
the end, and ``GROUPS`` groups that the remaining words fall into by their
first two bytes; a word within its group has the smoothed share (c + 0.5) /
(N_group + 0.5 (V_group + 1)), where the extra 1 stands for unseen words. So
every text has a proper probability whatever its words.

* Output: P(class) * P(token | class), with classes of equal token mass.
* Training: every training text, by truncated backpropagation over windows of
  ``STEPS`` tokens with the state carried on. A first model from a bounded
  sample (``SEED_TEXTS``) starts all tasks; each task goes over its share of
  the corpus, and the weights are averaged by tokens.
* Scoring: texts are packed into lanes; windows carry the state from the first
  token to the end, so the likelihood is that of the complete text.

Scale: the most frequent words (at most ``HEAD``, a fixed-size table) have
their counts broadcast; every other token's count is met by a join on the
word's 64-bit hash, where no key is frequent.

Defined results: a null or empty text has one token, the end; a null id counts
as training; with no training text the counts are zero and the model is the
untrained one; repeated rows each get their result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import chunks, hash_sample, map_arrow, map_texts, remainder, shared_table, utf8
from fleetspark.llm.gru import Adam, gru_backward, gru_forward, sum_rows
from fleetspark.llm.hashing import U, Words, mix

VOCABULARY, GROUPS, CLASSES, STATE = 1000, 64, 33, 16
HEAD = 1 << 19
#: Leading hash bits by which the head table is entered.
HEAD_BITS = 20
STEPS, LANES, SCORE_LANES = 32, 256, 512
#: Tokens of one scoring step: few open lanes (long texts) take longer windows.
SCORE_ROWS = 1 << 14
#: Largest logit whose exponential is taken as it is (float32 ends at 88).
SAFE_LOGIT = 80.0
SEED_TEXTS, SEED_RATE, RATE = 2000, 0.02, 0.004
#: Tasks that average the weights of all tasks; the driver averages their results.
AVERAGERS = 8
#: Text bytes that are scored or trained on at a time.
CHUNK = 6 << 20
END_HASH = U(1)
_LN10 = math.log(10.0)


def _group(words: Words) -> np.ndarray:
    """Group of each word, from its first two bytes."""
    first = words.data[words.start].astype(U)
    second = np.where(words.stop - words.start > 1, words.data[np.minimum(words.start + 1, len(words.data) - 1)], 0).astype(U)
    return (mix(first * U(256) + second) >> U(58)).astype(np.int64)


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with an end after each text, their groups, and the bounds of the texts."""
    words = Words([r.lower() for r in part.column("raw").to_pylist()])
    last = words.first[1:]
    return np.insert(words.hash, last, END_HASH), np.insert(_group(words), last, 0), words.first + np.arange(len(words.first))


def count_tokens(train: DataFrame) -> DataFrame:
    """word (64-bit hash), grp, c over all training texts; each task adds up its own counts first."""

    def run(batches):
        held = [np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64)]
        for part in chunks(batches, "raw"):
            h, g, _ = _tokens(part)
            word, at, n = np.unique(h, return_index=True, return_counts=True)
            place = np.searchsorted(held[0], word)
            known = place < len(held[0])
            known[known] = held[0][place[known]] == word[known]
            held[2][place[known]] += n[known]
            held = [np.insert(old, place[~known], new[~known]) for old, new in zip(held, (word, g[at], n))]
            if len(held[0]) > 1_000_000:
                yield _counts(held)
                held = [np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64)]
        yield _counts(held)

    return map_arrow(train, run, "word long, grp int, c long").groupBy("word").agg(F.first("grp").alias("grp"), F.sum("c").alias("c"))


def _counts(held: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"word": pa.array(held[0].view(np.int64)), "grp": pa.array(held[1].astype(np.int32)), "c": pa.array(held[2])})


@dataclass
class Lexicon:
    """Counts of the frequent words (sorted by hash), corpus totals, and the network's token ids.

    Ids: 0 the end, 1.. words, then groups."""

    word: np.ndarray
    count: np.ndarray
    total: int
    distinct: int
    group_total: np.ndarray
    group_distinct: np.ndarray
    ident: np.ndarray
    n_ids: int
    mass: np.ndarray
    #: First place in ``word`` by leading hash bits.
    start: np.ndarray = field(init=False, repr=False)

    def __post_init__(self):
        self.start = np.searchsorted(self.word, np.arange(1 << HEAD_BITS, dtype=U) << U(64 - HEAD_BITS)).astype(np.int32)

    @property
    def base_divisor(self) -> float:
        return math.log10(self.total + 0.5 * (self.distinct + 1))

    @property
    def group_divisor(self) -> np.ndarray:
        return np.log10(self.group_total + 0.5 * (self.group_distinct + 1))

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash in the head table, or -1."""
        if not len(self.word):
            return np.full(len(h), -1)
        last = len(self.word) - 1
        at = np.minimum(self.start[(h >> U(64 - HEAD_BITS)).astype(np.int64)], last)
        below = np.flatnonzero(self.word[at] < h)
        while len(below):  # a few words share their leading bits
            at[below] += 1
            below = below[at[below] <= last]
            below = below[self.word[at[below]] < h[below]]
        at = np.minimum(at, last)
        return np.where(self.word[at] == h, at, -1)

    def ids(self, place: np.ndarray, group: np.ndarray) -> np.ndarray:
        own = self.ident[place] if len(self.ident) else np.full(len(place), -1)
        return np.where((place >= 0) & (own >= 0), own, self.n_ids - GROUPS + group)


def build_lexicon(counts: DataFrame) -> tuple[Lexicon, int]:
    """The lexicon, and the least count of its head words."""
    step = F.floor(F.log2("c") * 64)
    levels = counts.groupBy(step.alias("level")).agg(F.count("*").alias("n"), F.min("c").alias("least")).orderBy(F.desc("level")).collect()
    held, least = 0, None
    for row in levels:  # at most 64 levels for each power of two
        if held + row["n"] > HEAD:
            break
        held, least = held + row["n"], row["least"]
    least = least if least is not None else 1 << 62
    head = counts.where(F.col("c") >= least).toArrow()
    word, count, group = (head[c].to_numpy() for c in ("word", "c", "grp"))
    word = word.view(U)
    order = np.argsort(word)
    word, count, group = word[order], count[order], group[order]
    total = counts.agg(F.sum("c").alias("t"), F.count("*").alias("v")).first()
    ident = np.full(len(word), -1)
    frequent = np.lexsort((word, -count))
    frequent = frequent[word[frequent] != END_HASH][:VOCABULARY]
    ident[frequent] = 1 + np.arange(len(frequent))
    ident[word == END_HASH] = 0
    n_ids = 1 + len(frequent) + GROUPS
    g_total, g_distinct = np.zeros(GROUPS), np.zeros(GROUPS)
    for row in counts.groupBy("grp").agg(F.sum("c").alias("t"), F.count("*").alias("v")).collect():
        g_total[row["grp"]], g_distinct[row["grp"]] = row["t"], row["v"]
    apart = ident >= 0  # words with an id of their own leave their group; the end never was in one
    np.subtract.at(g_total, group[apart], count[apart])
    np.subtract.at(g_distinct, group[apart], 1)
    ends = word == END_HASH
    if not ends.any() and total["t"]:  # the end is no word of a group even if it is not in the head
        end = counts.where(F.col("word") == int(END_HASH)).first()
        g_total[end["grp"]] -= end["c"]
        g_distinct[end["grp"]] -= 1
    mass = np.concatenate([[count[ends].sum()], count[frequent], g_total]) + 1.0
    return Lexicon(word, count, total["t"] or 0, total["v"] or 0, g_total, g_distinct, ident, n_ids, mass), least


def _log_softmax(w: np.ndarray, b: np.ndarray, states: np.ndarray, own: np.ndarray, safe: bool, gradient: bool):
    """Log probability of each column's own row, and (with ``gradient``) the gradient of the logits (m, n).

    ``states`` is (STATE, n): sums over the m choices then run along whole rows."""
    e = w @ states
    e += b[:, None]
    if not safe:
        e -= e.max(axis=0)
    r = np.arange(states.shape[1])
    mine = e[own, r]
    np.exp(e, out=e)
    total = e.sum(axis=0)
    if not gradient:
        return mine - np.log(total), None
    e /= total
    e[own, r] -= 1
    return mine - np.log(total), e


class Network:
    """Weights and passes of the model; classes split the ids, by mass, into parts of about equal mass."""

    def __init__(self, mass: np.ndarray, seed: int = 1):
        rnd, n = np.random.default_rng(seed), len(mass)
        order = np.argsort(-mass, kind="stable")
        share = np.cumsum(mass[order]) / mass.sum()
        of = np.minimum((np.concatenate([[0], share[:-1]]) * CLASSES).astype(int), CLASSES - 1)
        _, of = np.unique(of, return_inverse=True)
        self.of = np.empty(n, int)
        self.of[order] = of
        self.members = [order[of == c] for c in range(of[-1] + 1)]
        self.place = np.empty(n, int)
        for m in self.members:
            self.place[m] = np.arange(len(m))
        p = mass / mass.sum()
        in_class = np.array([p[m].sum() for m in self.members])
        f32 = np.float32
        self.weights = {
            "x": rnd.normal(0, 0.1, (n, 3 * STATE)).astype(f32), "u": rnd.normal(0, 0.2, (STATE, 3 * STATE)).astype(f32),
            "wc": rnd.normal(0, 0.1, (STATE, len(self.members))).astype(f32), "bc": np.log(in_class).astype(f32)[None, :],
            "wo": rnd.normal(0, 0.1, (n, STATE)).astype(f32), "bo": np.log(p / in_class[self.of]).astype(f32)[:, None],
        }

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.weights.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k, v in self.weights.items():
            self.weights[k] = flat[at:at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size

    def output(self, h: np.ndarray, target: np.ndarray, gradients: dict | None = None):
        """Natural log probability of each target; with ``gradients``, also fills them and returns the gradient of h."""
        w, n = self.weights, len(target)
        of = self.of[target]
        order = np.argsort(of.astype(np.int16), kind="stable")  # by class, so that each class is a slice
        cuts = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(self.members)))])
        h, of, place = h[order], of[order], self.place[target[order]]
        states = np.ascontiguousarray(h.T)
        # states lie within -1..1, which bounds every logit
        safe = max(float((np.abs(w["wo"]).sum(axis=1) + np.abs(w["bo"][:, 0])).max()), float((np.abs(w["wc"]).sum(axis=0) + np.abs(w["bc"][0])).max())) <= SAFE_LOGIT
        logs, d = _log_softmax(w["wc"].T, w["bc"][0], states, of, safe, gradients is not None)
        d_h = None
        if gradients is not None:
            gradients["wc"], gradients["bc"] = (d @ h).T / n, d.sum(axis=1)[None, :] / n
            d_h = d.T @ w["wc"].T
            gradients["wo"], gradients["bo"] = np.zeros_like(w["wo"]), np.zeros_like(w["bo"])
        for c, m in enumerate(self.members):
            at = slice(cuts[c], cuts[c + 1])
            if at.start == at.stop or len(m) == 1:
                continue
            more, d = _log_softmax(w["wo"][m], w["bo"][m, 0], states[:, at], place[at], safe, gradients is not None)
            logs[at] += more
            if gradients is not None:
                gradients["wo"][m], gradients["bo"][m, 0] = d @ h[at] / n, d.sum(axis=1) / n
                d_h[at] += d.T @ w["wo"][m]
        out = np.empty_like(logs)
        out[order] = logs
        if gradients is None:
            return out
        back = np.empty_like(d_h)
        back[order] = d_h / np.float32(n)
        return out, back

    def train(self, ids: np.ndarray, optimizer: Adam) -> None:
        """One pass over a stream of ids (each text followed by its end), in lanes with the state carried on."""
        lanes = min(LANES, max(1, len(ids) // (4 * STEPS)))
        length = -(-len(ids) // lanes)
        if not length:
            return
        target = np.zeros(lanes * length, ids.dtype)
        target[:len(ids)] = ids
        target = target.reshape(lanes, length).T
        real = (np.arange(lanes * length) < len(ids)).reshape(lanes, length).T  # the last lanes may end before the others
        source = np.concatenate([np.zeros((1, lanes), ids.dtype), target[:-1]])
        h = np.zeros((lanes, STATE), np.float32)
        for t in range(0, length, STEPS):
            x, y = source[t:t + STEPS], target[t:t + STEPS].ravel()
            at = np.flatnonzero(real[t:t + STEPS])
            fresh = x == 0
            states, kept = gru_forward(self.weights["x"][x], self.weights["u"], h, fresh, keep=True)
            gradients: dict[str, np.ndarray] = {}
            if len(at) == len(y):
                _, d_h = self.output(states.reshape(-1, STATE), y, gradients)
            else:
                d_h = np.zeros((len(y), STATE), np.float32)
                d_h[at] = self.output(states.reshape(-1, STATE)[at], y[at], gradients)[1]
            d_x, gradients["u"] = gru_backward(d_h.reshape(states.shape), self.weights["u"], kept, fresh)
            gradients["x"] = sum_rows(x.ravel().astype(np.min_scalar_type(len(self.of))), d_x.reshape(-1, 3 * STATE), len(self.weights["x"]))
            optimizer.step(gradients)
            h = states[-1]

    def score(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Natural log probability of each text (its ids end with the end)."""
        sizes = np.diff(bounds)
        lanes = [(0, k, []) for k in range(min(SCORE_LANES, len(sizes)))]
        for d in np.argsort(-sizes, kind="stable").tolist():
            load, k, mine = heapq.heappop(lanes)
            mine.append(d)
            heapq.heappush(lanes, (load + int(sizes[d]), k, mine))
        lanes.sort(key=lambda x: -x[0])
        loads = np.array([x[0] for x in lanes])
        first = np.concatenate([[0], np.cumsum(loads)[:-1]])
        # lane after lane, as long as the texts together; every text follows an end, so each starts from 0
        texts = np.array([d for _, _, mine in lanes for d in mine], np.int64)
        doc = np.repeat(texts, sizes[texts])
        target = ids[np.arange(len(doc)) + np.repeat(bounds[texts] - np.concatenate([[0], np.cumsum(sizes[texts])[:-1]]), sizes[texts])]
        source = np.concatenate([np.zeros(1, ids.dtype), target[:-1]])
        out = np.zeros(len(sizes))
        h = np.zeros((len(lanes), STATE), np.float32)
        t = 0
        while t < loads[0]:
            n = int(np.searchsorted(-loads, -t, "left"))  # lanes still open
            steps = min(max(STEPS, SCORE_ROWS // n), max(STEPS, int(loads[(n - 1) // 2]) - t), int(loads[0]) - t)
            step = t + np.arange(steps)[:, None]
            real = step < loads[:n]
            at = np.where(real, first[:n] + step, first[:n])
            x = source[at]
            states = gru_forward(self.weights["x"][x], self.weights["u"], h[:n], x == 0)
            at = at[real]
            out += np.bincount(doc[at], self.output(states[real], target[at]), len(out))
            h, t = states[-1], t + steps
        return out


def _fit(train: DataFrame, lexicon: Lexicon) -> Network:
    """Seed model from a bounded sample, then one pass of every task over its share, averaged by tokens."""
    spark = train.sparkSession
    shared = spark.sparkContext.broadcast(lexicon)

    def passes(start: np.ndarray | None, rate: float):
        def run(batches):
            lex = shared.value
            net, seen = Network(lex.mass), 0
            if start is not None:
                net.load(start)
            optimizer = Adam(net.weights, rate)
            for part in chunks(batches, "raw", CHUNK):
                h, g, _ = _tokens(part)
                net.train(lex.ids(lex.look_up(h), g), optimizer)
                seen += len(h)
            if seen:
                yield pa.RecordBatch.from_pydict({"tokens": pa.array([float(seen)]), "weights": pa.array([net.flat().tobytes()], pa.binary())})
        return run

    def average(batches):
        total, seen = None, 0.0
        for b in batches:
            for n, w in zip(b.column("tokens").to_pylist(), b.column("weights").to_pylist()):
                w = np.frombuffer(w, np.float32).astype(np.float64) * n
                total, seen = w if total is None else total + w, seen + n
        if seen:
            yield pa.RecordBatch.from_pydict({"tokens": pa.array([seen]), "weights": pa.array([(total / seen).astype(np.float32).tobytes()], pa.binary())})

    schema = "tokens double, weights binary"
    net = Network(lexicon.mass)
    texts = train.count()
    if not texts:
        return net
    draw = F.xxhash64("id", "raw")  # copies of one text are drawn apart, and trained on in a fixed order
    sample = hash_sample(train, draw, SEED_TEXTS, texts).repartition(1).sortWithinPartitions(draw, "raw").select("raw")
    first = map_arrow(sample, passes(None, SEED_RATE), schema).collect()
    start = np.frombuffer(first[0]["weights"], np.float32) if first else net.flat()
    trained = map_arrow(train.select("raw"), passes(start, RATE), schema)
    rows = map_arrow(trained.repartition(AVERAGERS), average, schema).collect()
    weight = sum(r["tokens"] for r in rows)
    net.load(sum(np.frombuffer(r["weights"], np.float32).astype(np.float64) * (r["tokens"] / weight) for r in rows))
    return net


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_fold: int = 1) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    held_out = F.coalesce(remainder(id_col, folds) == held_fold, F.lit(False))
    src = docs.select(F.col(id_col), held_out.alias("held_out"), utf8(text_col).alias("raw"))
    train = src.where(~F.col("held_out")).select(F.col(id_col).alias("id"), "raw")
    counts = shared_table(spark, count_tokens(train.select("raw")), "tokens")
    lexicon, least = build_lexicon(counts)
    network = _fit(train, lexicon)
    shared = spark.sparkContext.broadcast((lexicon, network))

    def step(part: pa.RecordBatch) -> dict:
        lex, net = shared.value
        h, g, bounds = _tokens(part)
        place = lex.look_up(h)
        ids = lex.ids(place, g)
        in_head, in_group = place >= 0, ids >= lex.n_ids - GROUPS
        logs = np.where(in_head, np.log10(np.where(in_head, lex.count[place] if len(lex.count) else 0, 0) + 0.5), 0.0)
        cut = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[bounds])
        divisor = np.where(in_group, lex.group_divisor[g], 0.0)
        n = np.diff(bounds)
        doc = np.repeat(np.arange(len(n)), n)[~in_head]
        pair, m = np.unique(np.stack([doc.astype(U), h[~in_head]], axis=1), axis=0, return_counts=True) if len(doc) else (np.empty((0, 2), U), np.empty(0, int))
        cuts = np.searchsorted(pair[:, 0].astype(np.int64), np.arange(len(n) + 1)).astype(np.int32)
        rare = pa.StructArray.from_arrays([pa.array(pair[:, 1].view(np.int64) if len(pair) else np.empty(0, np.int64)), pa.array(m.astype(np.int64))], ["word", "m"])
        return {id_col: part.column(id_col), "held_out": part.column("held_out"), "n_tokens": pa.array(n.astype(np.int64)),
                "n_known": pa.array(cut(in_head).astype(np.int64)), "base": pa.array(cut(logs)),
                "model": pa.array(net.score(ids, bounds) / _LN10 + cut(np.where(in_group, logs, 0.0) - divisor)),
                "rare": pa.ListArray.from_arrays(pa.array(cuts), rare)}

    schema = (f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, base double, model double, "
              "rare array<struct<word: long, m: long>>")
    scored = map_texts(src, step, schema, limit=CHUNK).withColumn("place", F.monotonically_increasing_id())
    # element 0 carries the text's own columns; its word is a spread key that adds nothing
    own = F.struct(F.xxhash64("place").alias("word"), F.lit(0).cast("long").alias("m"))
    tokens = scored.select("place", F.struct(id_col, "held_out", "n_tokens", "n_known", "base", "model").alias("text"),
                           F.posexplode(F.concat(F.array(own), "rare")).alias("at", "token"))
    tokens = tokens.select("place", F.when(F.col("at") == 0, F.col("text")).alias("text"), "token.word", "token.m")
    tail = counts.where(F.col("c") < least).select("word", "c")
    found = tokens.join(tail, "word", "left").groupBy("place").agg(
        F.first("text", ignorenulls=True).alias("text"),
        F.sum(F.col("m") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("tail"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("m")).otherwise(0)).alias("known"))
    return found.select(f"text.{id_col}", "text.held_out", "text.n_tokens", (F.col("text.n_known") + F.col("known")).alias("n_known"),
                        F.lit(lexicon.total).cast("long").alias("train_tokens"),
                        (F.col("text.base") + F.col("tail") - F.col("text.n_tokens") * F.lit(lexicon.base_divisor)).alias("base_score"),
                        (F.col("text.model") + F.col("tail")).alias("score"))
