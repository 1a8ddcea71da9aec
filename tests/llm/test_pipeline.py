"""The pipeline's stages against brute force, and the registered queries."""

import duckdb
import pytest
from helpers import SF, frame

import __spark_entry__ as entry
import corpus_pipeline as cp
from fleetspark.llm import queries
from test_chosen_path import brute as near_brute
from test_decontaminate import brute as bench_brute
from test_quality import brute as rules_brute


def test_registered():
    assert set(queries.QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    seen = docs
    for name, stage in cp.STAGES[:-1]:
        out = cp.shared_table(spark, stage(spark, seen, SF), name)
        assert out.columns == docs.columns
        before, after = {r["doc_id"]: r["text"] for r in seen.collect()}, {r["doc_id"]: r["text"] for r in out.collect()}
        if name == "quality_rules":
            base = {i for i, t in rows.items() if rules_brute(t)[0] >= 50 and 100 * rules_brute(t)[4] <= 50 * rules_brute(t)[0]}
            assert set(after) <= base and len(after) >= 0.9 * len(base)
        elif name == "ngram_jaccard_join":
            items = sorted(before.items())
            _, near = near_brute(items)
            label = list(range(len(items)))
            for _ in items:
                label = [min([label[k], *(label[j] for j in x)]) for k, x in enumerate(near)]
            assert set(after) == {items[k][0] for k in set(label)}
        elif name == "decontamination":
            bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(after) == {x[0] for x in bench_brute(list(before.items()), bench) if not x[4]}
        else:
            assert set(after) == set(before)
        seen = out
    last = cp.STAGES[-1][1](spark, seen, SF)
    assert last.count() == seen.count() and cp.run(spark, SF).select("doc_id", "ids_sha256").exceptAll(last.select("doc_id", "ids_sha256")).count() == 0


def test_stages_on_an_empty_table(spark):
    df = frame(spark, [])
    for _, stage in cp.STAGES:
        assert stage(spark, df, SF).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*cols).collect()), key=str) == sorted(res.fetchall(), key=str)
