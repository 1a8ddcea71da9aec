"""N-gram Jaccard join by chosen paths.

A text's set are its sequences of ``words`` consecutive words (a shorter text
is one sequence). Sets are embedded as ``COORDINATES`` min-hash tokens. A run
starts with all sets in one bucket; a bucket that is too large samples tokens
(coordinate i with probability 1 / (threshold * COORDINATES), drawn from the bucket's path)
and sends each set to the buckets of its sampled tokens, so sets meet where
they share a sampled token. Buckets of at most ``BUCKET`` sets, and all at
``DEPTH``, are compared by brute force in blocks of bounded size. The runs repeat until
the chance to miss a pair at the threshold is below ``1 - recall``.

Brute force compares short sketches first, then the full sets, exactly. A pair
that meets in several buckets is counted in the first of them (by bucket key),
so links are counted once, without a table of pairs: a block returns, per set,
its number of links and the smallest member of its local component.

Scale: equal sets are one class before the join, so exact copies never form
pairs. Rows carry 8-byte keys; full sets travel only for sets that have a
candidate partner. A dense group of many different texts is compared in
blocks, with memory bounded by the block.

Defined results: a null or empty text has no set, no link and a class of its
own; equal ids and repeated rows are separate documents; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import map_arrow, map_texts, shared_table, utf8
from fleetspark.llm.components import components
from fleetspark.llm.hashing import U, Ranges, Words, mix
from fleetspark.llm.substrings import Filter

COORDINATES = 64
#: Sets of a bucket that is compared without further splitting, and of a block.
BUCKET = 1000
DEPTH = 3
#: Standard deviations that a sketch may fall short of the threshold before its pair is passed over.
MARGIN = 4.7


def runs_needed(threshold: float, recall: float, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold is missed with probability at most 1 - recall.

    At a split such a pair shares a Poisson(1) number of children; p is its chance to stay together down to ``depth``."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def shingles(raws: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within the text, and the bounds of each text."""
    words = Words(raws)
    n, first = np.diff(words.first), words.first[:-1]
    doc = words.text_of()
    start = np.arange(len(doc))
    full = start + size <= words.first[1:][doc] if len(doc) else np.zeros(0, bool)
    short = np.flatnonzero((n > 0) & (n < size))
    start, ranges = start[full], Ranges(words.hash)
    h = np.concatenate([ranges.hashes(start, start + size), ranges.hashes(first[short], first[short] + n[short])])
    of = np.concatenate([doc[full], short])
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    h, of = h[new], of[new]
    return h, np.searchsorted(of, np.arange(len(raws) + 1))


_SALTS = mix(np.arange(1, COORDINATES + 1, dtype=U) * U(0x9E3779B97F4A7C15))


def min_hashes(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """32-bit min-hashes (texts x COORDINATES) of non-empty sets."""
    out = np.zeros((len(bounds) - 1, COORDINATES), np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        for k, salt in enumerate(_SALTS):
            hashed = (((h ^ salt) * U(0xD1342543DE82EF95)) >> U(32)).astype(np.uint32)
            out[some, k] = np.minimum.reduceat(hashed, bounds[some])
    return out


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def signatures(docs: DataFrame, keep: list[str], text_col: str, size: int) -> DataFrame:
    """Per input row: kept (struct), row (64-bit key of the kept values and text), n (set size), set_key (128 bits), hashes."""
    src = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept"), utf8(text_col).alias("raw"),
                      F.xxhash64(*[F.col(c) for c in keep], F.col(text_col)).alias("row"))

    def step(part: pa.RecordBatch) -> dict:
        h, bounds = shingles(part.column("raw").to_pylist(), size)
        keys = np.stack([np.add.reduceat(np.append(mix(h + U(s)), U(0)), bounds[:-1]) for s in (1, 2)], axis=1)
        return {"kept": part.column("kept"), "row": part.column("row"), "n": pa.array(np.diff(bounds).astype(np.int32)),
                "set_key": _binary(keys), "hashes": _binary(min_hashes(h, bounds))}

    kept = src.schema["kept"].dataType.simpleString()
    return map_texts(src, step, f"kept {kept}, row long, n int, set_key binary, hashes binary")


def _children(sets: DataFrame, threshold: float) -> DataFrame:
    """path, cls of the buckets that each set goes to from its bucket."""
    bar = U(int((1 << 64) / (threshold * COORDINATES)))

    def run(batches):
        for b in batches:
            path = b.column("path").to_numpy().view(U)
            hashes = _matrix(b.column("hashes"), np.uint32, COORDINATES)
            for lo in range(0, len(path), 4096):
                p, m = path[lo:lo + 4096], hashes[lo:lo + 4096]
                drawn = mix(p[:, None] + _SALTS[None, :]) < bar
                i, k = np.nonzero(drawn)
                child = mix(mix(p[i] + _SALTS[k]) ^ (m[i, k].astype(U) + U(1)))
                yield pa.RecordBatch.from_pydict({"path": pa.array(child.view(np.int64)),
                                                  "cls": pa.array(b.column("cls").to_numpy()[lo:lo + 4096][i])})

    return map_arrow(sets.select("path", "cls", "hashes"), run, "path long, cls long")


def buckets(classes: DataFrame, threshold: float, runs: int) -> DataFrame:
    """bucket, cls, size: the buckets to compare, from all runs and depths."""
    spark = classes.sparkSession
    roots = [int(x) for x in mix(np.arange(1, runs + 1, dtype=U)).view(np.int64)]
    level = classes.select(F.explode(F.array(*[F.lit(x) for x in roots])).alias("path"), "cls", "hashes")
    out = None
    for depth in range(1, DEPTH + 1):
        went = shared_table(spark, _children(level, threshold), "paths")
        sizes = went.groupBy(F.col("path").alias("bucket")).agg(F.count("*").alias("size")).where("size > 1")
        members = shared_table(spark, went.join(sizes, went.path == sizes.bucket).select("bucket", "cls", "size"), "buckets")
        leaf = members if depth == DEPTH else members.where(F.col("size") <= BUCKET)
        out = leaf if out is None else out.union(leaf)
        if depth < DEPTH:
            level = members.where(F.col("size") > BUCKET).join(classes.select("cls", "hashes"), "cls").withColumnRenamed("bucket", "path")
    return shared_table(spark, out.distinct(), "leaves")


def _blocks(leaves: DataFrame) -> DataFrame:
    """Adds block (text): members of a large bucket go to every pair of blocks that holds their own."""
    n = F.ceil(F.col("size") / BUCKET)
    own = F.pmod(F.xxhash64("cls"), n)
    other = F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    return (leaves.withColumn("own", own).withColumn("other", other)
                  .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")))


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Tables of equal key columns from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for i, j in zip(cuts, cuts[1:]):
            key = tuple(keys[i])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(i, j - i))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _sketch_pairs(t: dict, bucket: int, low: int, high: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of a block that may reach the threshold and first meet in this bucket."""
    n, own, sketch = t["n"], t["own"], t["sketch"]
    least = threshold * COORDINATES - MARGIN * math.sqrt(threshold * (1 - threshold) * COORDINATES)
    # buckets with a smaller key that hold two members: a pair that shares one is counted there
    flat = np.concatenate(t["leaves"])
    of = np.repeat(np.arange(len(n)), [len(x) for x in t["leaves"]])
    earlier = flat < bucket
    flat, of = flat[earlier], of[earlier]
    _, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    keep = count[place] > 1
    column = np.full(len(count), -1)
    column[count > 1] = np.arange((count > 1).sum())
    met = np.zeros((len(n), max(1, int((count > 1).sum()))), np.float32)
    met[of[keep], column[place[keep]]] = 1
    found = []
    for i in range(0, len(n), 32):
        s = slice(i, min(i + 32, len(n)))
        j0 = s.start
        ok = (sketch[s, None, :] == sketch[None, j0:, :]).sum(axis=2) >= least
        ok &= np.minimum(n[s, None], n[None, j0:]) >= threshold * np.maximum(n[s, None], n[None, j0:]) - 1e-9
        ok &= np.arange(s.start, s.stop)[:, None] < np.arange(j0, len(n))[None, :]
        if low != high:
            ok &= own[s, None] != own[None, j0:]
        if ok.any():
            ok &= (met[s] @ met[j0:].T) == 0
            a, b = np.nonzero(ok)
            found.append((a + s.start, b + j0))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def _common(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of set pairs."""
    if len(a) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b)], np.int64)
    flat, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1
    keep = count[place] > 1
    of, column = of[keep], column[place[keep]]
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        i, j = np.searchsorted(column, [lo, lo + 2048])
        has = np.zeros((len(sets), 2048), np.float32)
        has[of[i:j], column[i:j] - lo] = 1
        total += has @ has.T
    return total[a, b].astype(np.int64)


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each member's component among the given pairs."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


_GROUP = ["bucket", "low", "high"]


def _profile(table: pa.Table) -> dict:
    table = table.sort_by("cls")
    col = {c: table.column(c).combine_chunks() for c in table.column_names}
    leaves = [np.asarray(x, np.int64) for x in col["leaves"].to_pylist()]
    return {"cls": col["cls"].to_numpy(), "n": col["n"].to_numpy(), "docs": col["docs"].to_numpy(), "own": col["own"].to_numpy(),
            "leaves": leaves, "sketch": _matrix(col["hashes"], np.uint32, COORDINATES).astype(np.uint8),
            **({"sets": [np.frombuffer(x, U) for x in col["shingles"].to_pylist()]} if "shingles" in col else {})}


def links(docs: DataFrame, keep: list[str], text_col: str = "text", size: int = 5, threshold: float = 0.8,
          recall: float = 0.9999) -> DataFrame:
    """Per input row: kept (struct), row, set_key, cls (key of its class of equal sets; null without a set),
    component (smallest class key that links reach) and n_links (other rows within the threshold)."""
    spark = docs.sparkSession
    signed = signatures(docs, keep, text_col, size)
    rows = shared_table(spark, signed, "signatures")
    classes = shared_table(spark, rows.where("n > 0").groupBy("set_key")
                           .agg(F.min(F.struct("row", "n", "hashes")).alias("top"), F.count("*").alias("docs"))
                           .select("set_key", F.col("top.row").alias("cls"), "docs", F.col("top.n").alias("n"), F.col("top.hashes").alias("hashes")),
                           "classes")
    leaves = buckets(classes, threshold, runs_needed(threshold, recall))
    profile = (classes.join(leaves.groupBy("cls").agg(F.collect_list("bucket").alias("leaves")), "cls")
                      .select("cls", "docs", "n", "hashes", "leaves"))
    blocks = (_blocks(leaves).select(*_GROUP, "own", "cls").join(profile, "cls")
              .repartition(*_GROUP).sortWithinPartitions(*_GROUP))

    def screen(batches):
        for group in _groups(batches, _GROUP):
            key = [group.column(c)[0].as_py() for c in _GROUP]
            t = _profile(group)
            a, b = _sketch_pairs(t, *key, threshold)
            need = np.unique(np.concatenate([a, b]))
            if len(need):
                yield pa.RecordBatch.from_pydict({**{c: pa.array(np.full(len(need), k, np.int64)) for c, k in zip(_GROUP, key)},
                                                  "cls": pa.array(t["cls"][need]), "own": pa.array(t["own"][need])})

    near = shared_table(spark, map_arrow(blocks, screen, "bucket long, low long, high long, cls long, own long"), "near")
    wanted = spark.sparkContext.broadcast(Filter.of(near.select(F.col("cls").alias("key")).distinct()))
    src = docs.select(utf8(text_col).alias("raw"), F.xxhash64(*[F.col(c) for c in keep], F.col(text_col)).alias("row"))

    def full_sets(part: pa.RecordBatch) -> dict:
        part = part.filter(pa.array(wanted.value.has(part.column("row").to_numpy().view(U))))
        h, bounds = shingles(part.column("raw").to_pylist(), size)
        return {"row": part.column("row"), "shingles": pa.array([h[i:j].tobytes() for i, j in zip(bounds, bounds[1:])], pa.binary())}

    sets = map_texts(src, full_sets, "row long, shingles binary").groupBy(F.col("row").alias("cls")).agg(F.first("shingles").alias("shingles"))
    compared = near.join(profile, "cls").join(sets, "cls").repartition(*_GROUP).sortWithinPartitions(*_GROUP)

    def compare(batches):
        for group in _groups(batches, _GROUP):
            key = [group.column(c)[0].as_py() for c in _GROUP]
            t = _profile(group)
            a, b = _sketch_pairs(t, *key, threshold)
            if not len(a):
                continue
            both = _common(t["sets"], a, b)
            ok = both >= threshold * (t["n"][a] + t["n"][b] - both) - 1e-9
            a, b = a[ok], b[ok]
            n = np.zeros(len(t["cls"]), np.int64)
            np.add.at(n, a, t["docs"][b])
            np.add.at(n, b, t["docs"][a])
            some = np.flatnonzero(n)
            root = _local_roots(len(n), a, b)
            yield pa.RecordBatch.from_pydict({"cls": pa.array(t["cls"][some]), "root": pa.array(t["cls"][root[some]]), "n": pa.array(n[some])})

    linked = shared_table(spark, map_arrow(compared, compare, "cls long, root long, n long"), "links")
    label = components(linked.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    count = linked.groupBy("cls").agg(F.sum("n").alias("linked"))
    verdict = (classes.select("set_key", "cls", "docs").join(count, "cls", "left").join(label.withColumnRenamed("node", "cls"), "cls", "left")
                      .select("set_key", "cls", F.coalesce("label", "cls").alias("component"),
                              (F.col("docs") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")))
    found = rows.where("n > 0").select("kept", "row", "set_key").join(verdict, "set_key")
    without = rows.where("n = 0").select("kept", "row", "set_key", F.lit(None).cast("long").alias("cls"),
                                         F.lit(None).cast("long").alias("component"), F.lit(0).cast("long").alias("n_links"))
    return found.select(*without.columns).union(without)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per input row: id, class_id (smallest id of its linked texts and copies; its own without any), copy_id
    (smallest id among rows with an equal set) and n_links."""
    found = shared_table(docs.sparkSession, links(docs, [id_col], text_col, **options), "joined")
    found = found.select("kept.*", "cls", "component", "n_links")
    copies = found.groupBy("cls", "component").agg(F.min(id_col).alias("copy_id")).where("cls IS NOT NULL")
    groups = copies.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    names = copies.join(groups, "component").select("cls", "class_id", "copy_id")
    return (found.join(names, "cls", "left")
                 .select(id_col, F.coalesce("class_id", F.col(id_col)).alias("class_id"), F.coalesce("copy_id", F.col(id_col)).alias("copy_id"), "n_links"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows without near duplicates: of each component the row with the smallest id (then row key) stays."""
    spark = docs.sparkSession
    found = shared_table(spark, links(docs, [id_col], text_col, **options), "joined")
    first = (found.where("component IS NOT NULL").groupBy("component")
                  .agg(F.min(F.struct(F.col(f"kept.{id_col}").isNull().alias("last"), F.col(f"kept.{id_col}").alias("id"), "row")).alias("top"))
                  .select(F.col("top.row").alias("row"))
                  .union(found.where("component IS NULL").select("row")).distinct())
    # rows that repeat id and text are copies too: one stays; rows without words all stay
    again = found.where("component IS NOT NULL").groupBy("row").agg(F.count("*").alias("times")).where("times > 1").select("row")
    chosen = shared_table(spark, first.join(again.withColumn("repeats", F.lit(True)), "row", "left").select("row", F.coalesce("repeats", F.lit(False)).alias("repeats")),
                          "chosen")
    keyed = docs.withColumn("row_key_of_join", F.xxhash64(F.col(id_col), F.col(text_col)))

    def among(keys: DataFrame) -> DataFrame:
        """The rows of those keys, which alone are held in memory; the texts pass by unsorted."""
        keys = keys.select("row").hint("shuffle_hash")
        return keyed.join(keys, keyed.row_key_of_join == keys.row, "left_semi")

    once = among(chosen.where("repeats")).dropDuplicates(["row_key_of_join"])
    return among(chosen.where("NOT repeats")).union(once).drop("row_key_of_join")
