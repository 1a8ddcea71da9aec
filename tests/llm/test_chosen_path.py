import math
import random

from helpers import ODD_ROWS, WORD, data, frame

from fleetspark.llm import chosen_path as cp
from fleetspark.llm.components import components


def sets_of(text):
    w = WORD.findall(text or "")
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    s = [sets_of(t) for _, t, *_ in rows]
    near = [[j for j in range(len(s)) if j != i and s[i] and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j]) - 1e-9] for i in range(len(s))]
    return s, near


def edited(rnd, n, edits):
    w = [f"v{k}" for k in range(n)]
    for _ in range(edits):
        w[rnd.randrange(n)] = f"x{rnd.random()}"
    return " ".join(w)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cp, "BUCKET", 12)  # large buckets are split, then compared in blocks
    rnd = random.Random(3)
    rows = [(i, edited(rnd, 300, rnd.randint(0, 9)), "x") for i in range(70)]
    rows += [(100 + i, " ".join(f"u{rnd.randint(0, 10**9)}" for _ in range(rnd.randint(1, 60))), "x") for i in range(40)]
    rows += [(200, rows[0][1], "x"), (201, rows[0][1], "x"), (202, rows[80][1], "x")]
    rows += [(None if i is None else 500 + i, t, x) for i, t, x in ODD_ROWS]
    s, near = brute(rows)
    got = cp.near_duplicates(frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_links"]) for r in got) == sorted((str(i), len(x)) for (i, *_), x in zip(rows, near))
    by_id = {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None and r["doc_id"] != 501}  # 501 stands for two texts
    for (i, *_), x in zip(rows, near):
        assert i in (None, 501) or all(by_id[i] == by_id[rows[j][0]] for j in x if rows[j][0] is not None)
    assert by_id[200] == by_id[201] and by_id[202] == by_id[rows[80][0]] and by_id[103] != by_id[104]
    stay = cp.keep_one(frame(spark, rows)).collect()
    kept = [next(k for k, r in enumerate(rows) if r[:2] == (x["doc_id"], x["text"])) for x in stay]
    words = [k for k in kept if s[k]]
    assert len(set(words)) == len(words) and len(stay) - len(words) == sum(not x for x in s)
    reach = {k: k for k in range(len(rows))}

    def top(k):
        while reach[k] != k:
            k = reach[k]
        return k

    for k, x in enumerate(near):
        for j in x:
            reach[top(k)] = top(j)
    assert sorted(map(top, words)) == sorted({top(k) for k in range(len(rows)) if s[k]})


def test_recall_of_the_runs():
    runs = cp.runs_needed(0.8, 0.9999)
    p = 1 - math.exp(-1)
    for _ in range(cp.DEPTH - 1):
        p = 1 - math.exp(-p)
    assert (1 - p) ** runs <= 1e-4 < (1 - p) ** (runs - 1)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1040)] + [(5, 5), (7, 6)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[k] == 1000 for k in range(1000, 1040))


def test_empty_table(spark):
    assert cp.near_duplicates(frame(spark, [])).count() == 0
    assert cp.keep_one(frame(spark, [])).count() == 0
    assert data(cp.near_duplicates(frame(spark, [(3, None, "x")])), "doc_id", "class_id", "copy_id", "n_links") == [(3, 3, 3, 0)]


def test_keep_one_sorts_no_texts_and_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a b c d e f g", "x"), (1, "a b c d e f g", "x"), (2, "p q r s t u v", "x"), (3, "", "x"), (3, "", "x"), (None, "k l m n o", "x"), (None, "k l m n o", "x")]
    out = cp.keep_one(frame(spark, rows))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == [(0, "k l m n o"), (1, "a b c d e f g"), (2, "p q r s t u v"), (3, ""), (3, "")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") >= 2 and "SortMergeJoin" not in plan
