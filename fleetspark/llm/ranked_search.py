"""Ranked lexical search by range-maximum tables over posting lists.

``build_index`` packs the documents of every partition into segments of bounded text: per segment the
documents in id order, their lengths, and a posting list (documents and term frequencies) per term. A search
computes the impact of every posting of the query terms, which needs the statistics of the whole corpus, and a sparse
table of range maxima over each list. It then explores intervals of documents: the sum of the lists' range maxima
bounds every score inside, the interval with the highest bounds are taken first (a growing batch at a time, so that numpy
works on many), each is split at the document of its largest impact, which is scored exactly, and what is left is bounded
anew. Intervals that cannot reach the ten best so far go; the ten best of a task's earlier segments count too.

On Spark the index is built where the documents are read and moves nothing; document frequencies are one
join and sum over the query terms; a search moves ten rows per query and segment at most.

Queries are broadcast in blocks of at most ``BLOCK_BYTES`` of terms, one pass over the index for each block, so any number of queries works.

Scores: N documents with a term, L terms in all, n terms of one document, df documents with the term, tf its occurrences;
w = floor(1000 ln((2N+2) / (2df+1))), m = 100 - 75 + (75 n N) div L, score = sum of w * ((10^9 tf) div (1000 tf + 8 m)) over the
query's terms with their repeats.

Defined results: null and empty texts have no terms, neither match nor count; repeated rows are documents of their own; equal scores go by
ascending id, null ids last; every query row is a query of its own, also when its id repeats or is null; empty tables give no rows;
other columns are ignored. A segment holds whole texts: one longer than ``SEGMENT_TEXT`` is a segment alone.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fleetspark.llm.common import map_arrow, shared_table, utf8

#: Text bytes of one segment, and terms of one block of queries.
SEGMENT_TEXT, BLOCK_BYTES = 16 << 20, 8 << 20
#: Query terms up to this size are broadcast for the frequencies; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
#: Intervals taken at a time: from the first number, doubling up to the second.
BATCH = (8, 256)
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(raw: bytes) -> list[bytes]:
    return TERM.findall(raw.lower())  # of bytes, only A-Z change


class _Numbers(dict):
    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def _pack(ids: list, raws: list[bytes]) -> dict | None:
    """One segment; documents without terms are left out."""
    vocabulary, lengths, names, parts = _Numbers(), [], [], []
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, 0 if ids[i] is None else ids[i]))
    for i in order:
        found = list(map(vocabulary.__getitem__, terms_of(raws[i])))
        if found:
            parts.append(np.asarray(found, np.int64) * len(order) + len(names))
            names.append(ids[i])
            lengths.append(len(found))
    if not names:
        return None
    keys, tf = np.unique(np.concatenate(parts), return_counts=True)
    term, doc = np.divmod(keys, len(order))
    return {"ids": names, "lengths": np.asarray(lengths, "<i8").tobytes(), "n_docs": len(names), "n_terms": sum(lengths),
            "terms": list(vocabulary), "df": np.bincount(term, minlength=len(vocabulary)).tolist(),
            "docs": doc.astype("<u4").tobytes(), "tf": tf.astype("<u4").tobytes()}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_text: int = SEGMENT_TEXT) -> DataFrame:
    """Segments of all documents, written to the shared folder."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"ids array<{kind}>, lengths binary, n_docs long, n_terms long, terms array<binary>, df array<long>, docs binary, tf binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, raws, held = [], [], 0
        for batch in batches:
            id_type = batch.schema.field(0).type
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_buffer().to_pybytes()
                if held and held + len(raw) > segment_text:
                    yield from out(ids, raws, id_type)
                    ids, raws, held = [], [], 0
                ids.append(batch.column(0)[i].as_py())
                raws.append(raw)
                held += len(raw)
        if ids:
            yield from out(ids, raws, id_type)

    def out(ids, raws, id_type):
        one = _pack(ids, raws)
        if one is not None:
            types = {"ids": pa.list_(id_type), "lengths": pa.binary(), "n_docs": pa.int64(), "n_terms": pa.int64(), "terms": pa.list_(pa.binary()),
                     "df": pa.list_(pa.int64()), "docs": pa.binary(), "tf": pa.binary()}
            yield pa.RecordBatch.from_pydict({k: pa.array([one[k]], t) for k, t in types.items()})

    return shared_table(docs.sparkSession, map_arrow(docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("raw")), run, schema), "search-index")


class Segment:
    """Posting lists of the terms that some query asks for, with impacts and their range-maximum tables."""

    def __init__(self, row: dict, wanted: set[bytes], total_docs: int, total_terms: int):
        df = np.asarray(row["df"], np.int64)
        ends = np.cumsum(df)
        numbers = [i for i, t in enumerate(row["terms"]) if t in wanted]
        self.list_of = {row["terms"][i]: k for k, i in enumerate(numbers)}
        self.ids, self.size = row["ids"], row["n_docs"]
        self.named = self.size - sum(i is None for i in reversed(self.ids))
        docs, tf = np.frombuffer(row["docs"], "<u4"), np.frombuffer(row["tf"], "<u4")
        pick = [slice(ends[i] - df[i], ends[i]) for i in numbers]
        self.docs = np.concatenate([docs[p] for p in pick] or [docs[:0]]).astype(np.int64)
        tf = np.concatenate([tf[p] for p in pick] or [tf[:0]]).astype(np.int64)
        size = df[numbers]
        self.stop = np.cumsum(size)
        self.start = self.stop - size
        self.keys = np.repeat(np.arange(len(numbers)), size) * self.size + self.docs  # ascending: lists in turn, documents inside
        length = np.frombuffer(row["lengths"], "<i8")
        m = 100 - 75 + 75 * length * total_docs // total_terms
        self.impact = 10**9 * tf // (1000 * tf + 8 * m[self.docs])
        self._tables(int(size.max()) if len(numbers) else 0)

    def _tables(self, longest: int) -> None:
        """``best[k][i]``: position of the largest impact among the 2^k postings from i (the first of equals)."""
        level = np.arange(len(self.impact), dtype=np.int32)
        self.best, step = [level], 1
        while 2 * step <= longest:
            a, b = level[:-step], level[step:]
            level = np.concatenate([np.where(self.impact[a] >= self.impact[b], a, b), level[len(level) - step:]])
            self.best.append(level)
            step *= 2
        self.best = np.stack(self.best)
        self.log = np.zeros(longest + 1, np.int64)
        for k in range(1, len(self.best)):
            self.log[1 << k:] = k

    def range_best(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Positions of the largest impacts of posting ranges that are not empty."""
        k = self.log[hi - lo]
        a, b = self.best[k, lo], self.best[k, hi - (1 << k)]
        return np.where(self.impact[a] >= self.impact[b], a, b)

    def position_of(self, doc_id) -> int:
        """Documents of the segment that come before an id."""
        return self.named if doc_id is None else bisect_left(self.ids, doc_id, 0, self.named)

    def search(self, query: dict[bytes, int], best: "Best") -> None:
        """Offer all documents that can be among the best of a query ({term: weight times repeats})."""
        lists = [(self.list_of[t], w) for t, w in query.items() if t in self.list_of]
        if not lists:
            return
        number = np.array([k for k, _ in lists])
        weight = np.array([w for _, w in lists], np.int64)
        frontier = self._bounded(np.zeros(1, np.int64), np.full(1, self.size), self.start[number][None], self.stop[number][None], weight)
        limit = best.limit(self)
        take = BATCH[0]
        while len(frontier[0]):
            bound, first, last, lo, hi, at = frontier
            if len(bound) > take:
                chosen = np.argpartition(-bound, take)[:take]
                rest = np.ones(len(bound), bool)
                rest[chosen] = False
            else:
                chosen, rest = np.arange(len(bound)), np.zeros(len(bound), bool)
            take = min(2 * take, BATCH[1])
            doc, begin, end, lo_c, hi_c = self.docs[at[chosen]], first[chosen], last[chosen], lo[chosen], hi[chosen]
            # postings of the split document: where each list passes it
            row, col = np.nonzero(hi_c > lo_c)
            mid = lo_c.copy()
            mid[row, col] = np.searchsorted(self.keys, number[col] * self.size + doc[row])
            here = np.zeros(mid.shape, bool)
            inside = mid[row, col] < hi_c[row, col]
            row, col = row[inside], col[inside]
            here[row, col] = self.docs[mid[row, col]] == doc[row]
            score = np.where(here, weight * self.impact[np.where(here, mid, 0)], 0).sum(1)
            for d, s in zip(doc.tolist(), score.tolist()):
                if s > limit[0] or (s == limit[0] and d < limit[1]):
                    best.offer(s, self.ids[d])
                    limit = best.limit(self)
            parts = self._bounded(np.concatenate([begin, doc + 1]), np.concatenate([doc, end]), np.concatenate([lo_c, mid + here]),
                                  np.concatenate([mid, hi_c]), weight)
            joined = [np.concatenate([old[rest], new]) for old, new in zip(frontier, parts)]
            stays = (joined[0] > limit[0]) | ((joined[0] == limit[0]) & (joined[1] < limit[1]))
            frontier = [a[stays] for a in joined]

    def _bounded(self, first, last, lo, hi, weight):
        """Intervals with a posting, their bounds and the position of their largest weighted impact."""
        row, col = np.nonzero(hi > lo)
        most = np.zeros(lo.shape, np.int64)
        at = np.zeros(lo.shape, np.int64)
        where = self.range_best(lo[row, col], hi[row, col])
        at[row, col] = where
        most[row, col] = weight[col] * self.impact[where]
        bound = most.sum(1)
        kept = np.flatnonzero(bound > 0)
        top = most[kept].argmax(1)
        return bound[kept], first[kept], last[kept], lo[kept], hi[kept], at[kept, top]


class Best:
    """The best (score, id) pairs of one query so far."""

    def __init__(self, k: int):
        self.k, self.found = k, []

    def offer(self, score: int, doc_id) -> None:
        key = (-score, doc_id is None, 0 if doc_id is None else doc_id)
        at = bisect_left(self.found, key)
        self.found.insert(at, key)
        del self.found[self.k:]

    def limit(self, segment: Segment) -> tuple[int, int]:
        """What a document must beat: a score, or this score and a position in the segment below."""
        if len(self.found) < self.k:
            return 0, 0
        score, null, doc_id = self.found[-1]
        return -score, segment.position_of(None if null else doc_id)


def _queries(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """query (number), item, term, repeats; written once, so that numbers hold."""
    spark = items.sparkSession
    numbered = shared_table(spark, items.select(F.monotonically_increasing_id().alias("query"), F.col(id_col).alias("item"), utf8(text_col).alias("raw")),
                            "search-queries")
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for query, item, raw in zip(*(batch.column(i) for i in range(3))):
                seen: dict[bytes, int] = {}
                for t in terms_of(raw.as_py()):
                    seen[t] = seen.get(t, 0) + 1
                if seen:
                    n = len(seen)
                    yield pa.RecordBatch.from_pydict({"query": pa.array([query.as_py()] * n, pa.int64()), "item": pa.array([item.as_py()] * n, item.type),
                                                      "term": pa.array(list(seen), pa.binary()), "repeats": pa.array(list(seen.values()), pa.int64())})

    return shared_table(spark, map_arrow(numbered, run, f"query long, item {kind}, term binary, repeats long"), "search-terms")


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item."""
    spark = index.sparkSession
    totals = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    asked = _queries(items, id_col, text_col)
    out = f"query long, doc_id {id_type}, score long"
    size = asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    found = spark.createDataFrame([], out)
    if totals.docs and size:
        terms = asked.select("term").distinct()
        if size <= BROADCAST_BYTES:
            terms = F.broadcast(terms)
        df = (index.select(F.explode(F.arrays_zip("terms", "df")).alias("p")).select(F.col("p.terms").alias("term"), F.col("p.df").alias("df"))
              .join(terms, "term").groupBy("term").agg(F.sum("df").alias("df")))
        weight = F.floor(1000 * F.log((2 * F.lit(totals.docs) + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
        blocks = -(-size // block_bytes)
        weighted = shared_table(spark, asked.join(df.select("term", weight.alias("w")), "term").where("w > 0").select(
            F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block"), "query", "term", (F.col("w") * F.col("repeats")).alias("w")), "search-weights")
        for block in range(blocks):
            held: dict[int, dict[bytes, int]] = {}
            for r in weighted.where(F.col("block") == block).select("query", "term", "w").toLocalIterator():  # one block's terms
                held.setdefault(r.query, {})[bytes(r.term)] = r.w
            if held:
                found = found.unionByName(_search_block(index, held, totals.docs, totals.terms, k, out))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = asked.select(F.col("query").alias("_query"), F.col("item").alias(id_col)).distinct()
    return ranked.join(named, F.col("query") == F.col("_query")).select(id_col, "rank", "doc_id", "score")


def _search_block(index: DataFrame, held: dict[int, dict[bytes, int]], docs: int, terms: int, k: int, out: str) -> DataFrame:
    """Candidates of one block of queries: the best of every task."""
    shared = index.sparkSession.sparkContext.broadcast(held)
    id_kind = index.schema["ids"].dataType.elementType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        queries = shared.value
        wanted = {t for q in queries.values() for t in q}
        best = {q: Best(k) for q in queries}
        for batch in batches:
            for i in range(batch.num_rows):
                segment = Segment({n: batch.column(n)[i].as_py() for n in batch.schema.names}, wanted, docs, terms)
                for q, asked in queries.items():
                    segment.search(asked, best[q])
        rows = [(q, None if null else doc_id, -score) for q, b in best.items() for score, null, doc_id in b.found]
        if rows:
            q, ids, scores = zip(*rows)
            yield pa.RecordBatch.from_pydict({"query": pa.array(q, pa.int64()), "doc_id": pa.array(ids, to_arrow_type(id_kind)), "score": pa.array(scores, pa.int64())})

    return map_arrow(index, run, out)
