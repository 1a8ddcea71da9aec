import math
import random
import re
from collections import Counter

from helpers import ODD_ROWS, SF, data, frame

from fleetspark.llm import ranked_search as rs

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=10):
    """Every document scored for every item."""
    texts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    texts = [(i, c, sum(c.values())) for i, c in texts if c]
    n, total, df = len(texts), sum(size for _, _, size in texts), Counter(t for _, c, _ in texts for t in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        found = []
        for i, c, size in texts:
            m = 25 + 75 * size * n // total
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, times in asked.items() if t in c)
            if score > 0:
                found.append((-score, i is None, i if i is not None else 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


ITEMS = "item_id string, text string, query long, item string, term string, rank int, doc_id long, score long, w long"


def _items(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2, 3, 4, 5) for r in rows], ITEMS)


def _run(spark, docs, items, segment_text=rs.SEGMENT_TEXT, **more):
    index = rs.build_index(frame(spark, [(i, t, "x") for i, t in docs], "ids long, terms string, df long, docs long, tf string").repartition(3), segment_text=segment_text)
    return data(rs.search(index, _items(spark, items), **more), "item_id", "rank", "doc_id", "score")


def test_odd_texts_ties_and_repeats(spark):
    docs = [(i, t) for i, t, _ in ODD_ROWS] + [(None, "one two"), (9, "One, TWO"), (9, "one two"), (8, "one two"), (7, "\x00K one-two É")]
    items = [("a", "one two"), ("a", "one two"), (None, "ONE é 漢"), ("b", None), ("c", "w1 w2 w3 nowhere"), ("d", ""), ("e", "k K one one")]
    assert _run(spark, docs, items) == brute(docs, items)
    assert _run(spark, docs, items, segment_text=20, block_bytes=40) == brute(docs, items)
    assert _run(spark, docs, items, k=2) == brute(docs, items, 2)
    assert _run(spark, [], items) == [] and _run(spark, docs, []) == []


def test_many_equal_documents_and_common_words(spark):
    rnd = random.Random(1)
    docs = [(i, " ".join(rnd.choice("the of and a b c d e f g h i j k".split()) for _ in range(rnd.randint(1, 30)))) for i in range(800)]
    docs += [(1000 + i, "the of same copy here") for i in range(300)]
    items = [("x", "the of same copy"), ("y", "a b c d e f g"), ("z", "copy")]
    want = brute(docs, items)
    assert _run(spark, docs, items) == want and _run(spark, docs, items, segment_text=2000) == want


def test_other_id_types(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one")], "name string, body string")
    index = rs.build_index(docs, "name", "body")
    got = rs.search(index, _items(spark, [("q", "one")])).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [None, "a", "b"]


def test_given_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    items = [(str(i), t) for i, t in items]
    assert _run(spark, docs, items, segment_text=100_000, block_bytes=1000) == brute(docs, items)
