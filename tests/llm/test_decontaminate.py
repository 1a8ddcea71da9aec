import re

import pytest
from helpers import ODD_ROWS, SF, data, frame

from fleetspark.llm import decontaminate as dc
from pyspark.sql import functions as F

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, bench):
    wins = {}
    for item, text in bench:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[i:i + 13]), set()).update([] if item is None else [str(item)])
    out = []
    for i, text, *_ in rows:
        w, hit, items = words(text), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                found = wins.get(tuple(w[k:k + n]))
                if found is not None:
                    hit.update(range(k, k + n))
                    items |= found
        out.append((i, len(w), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


BENCH = [("b1", " ".join(f"q{i}" for i in range(20))), ("b2", "Short item, here"), ("b3", None), ("b4", "..."), ("b5", "short ITEM here"), (None, "solo"),
         ("b6", " ".join(f"w{i}" for i in range(100, 113)))]


@pytest.mark.parametrize("limit", [dc.BROADCAST_WINDOWS, 0])
def test_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(dc, "BROADCAST_WINDOWS", limit)
    rows = ODD_ROWS + [(20, "x " * 30 + " ".join(f"Q{i}" for i in range(2, 17)) + " x", "e"), (21, "a short, item: here! short item here", "e"),
                       (22, "solo " * 40, "e"), (23, "ÀÉ solo\x00solo", "e")]
    bench = spark.createDataFrame(BENCH, "item_id string, text string")
    got = data(dc.decontaminate(frame(spark, rows), bench, ["doc_id"]), "doc_id", "n_words", "n_hit", "items", "contaminated")
    assert got == brute(rows, BENCH)


def test_documents_and_empty_tables(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    got = data(dc.decontaminate(docs, bench, ["doc_id"]), "doc_id", "n_words", "n_hit", "items", "contaminated")
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert dc.decontaminate(docs.limit(0), bench, ["doc_id"]).count() == 0
    assert dc.decontaminate(docs, bench.limit(0), ["doc_id"]).where("contaminated").count() == 0


def test_remove_spans(spark):
    df = spark.createDataFrame([("A b c d",)], "text string").withColumn("s", F.array(F.struct(F.lit(1).alias("start"), F.lit(3).alias("stop"))))
    assert df.select(dc.remove_spans(F.col("text"), F.col("s")).alias("t")).first()["t"] == "a d"


def test_no_python_in_the_plan(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    plan = dc.decontaminate(docs, bench, ["doc_id"])._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("limit", [dc.BROADCAST_WINDOWS, 0])
def test_clashing_names(spark, monkeypatch, limit):
    monkeypatch.setattr(dc, "BROADCAST_WINDOWS", limit)
    names = ["n_words", "spans", "items", "N_hit", "contaminated", "window", "n", "_key", "_w", "_at", "anchor", "a.b"]
    docs = frame(spark, [(1, "solo", "x"), (2, "other words", "y"), (2, "other words", "y"), (3, None, "z")])
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(i))
    bench = spark.createDataFrame(BENCH, "item_id string, text string").withColumn("spans", F.lit(1)).withColumn("window", F.lit(2))
    left = dc.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(tuple(r) for r in left.collect()) == sorted(tuple(r) for r in docs.where("doc_id > 1").collect())
    got = dc.decontaminate(docs, bench, docs.columns)
    assert sorted(c.lower() for c in got.columns) == sorted(c.lower() for c in docs.columns)
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated, r.window) for r in got.collect()) == [
        (1, 1, 1, True, 5), (2, 2, 0, False, 5), (2, 2, 0, False, 5), (3, 0, 0, False, 5)]


def test_more_windows_than_are_broadcast(spark, monkeypatch):
    bench = [(f"i{k}", " ".join(f"k{k}x{i}" for i in range(10_200))) for k in range(20)] + BENCH  # 203,760 windows and the few above
    asked = []
    shuffle = dc._hits_by_shuffle
    monkeypatch.setattr(dc, "_hits_by_shuffle", lambda *a: asked.append(1) or shuffle(*a))
    rows = ODD_ROWS + [(20, " ".join(f"k3x{i}" for i in range(50, 80)) + " tail" * 9, "e"), (21, "a " * 500 + " ".join(f"K19x{i}" for i in range(10_187, 10_200)), "e"),
                       (22, " ".join(f"k5x{i}" for i in range(12)), "e"), (23, "short item here " * 3 + "solo", "e")]
    got = data(dc.decontaminate(frame(spark, rows), spark.createDataFrame(bench, "item_id string, text string"), ["doc_id"]),
               "doc_id", "n_words", "n_hit", "items", "contaminated")
    assert asked and got == brute(rows, bench)
