import re
from collections import Counter

import numpy as np
from helpers import ODD_ROWS, SF, WORD, data, frame

from fleetspark.llm import quality as q


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(tri)
    twice = {k + j for k, t in enumerate(tri) if seen[t] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(twice)


def test_measures_on_documents_and_odd_rows(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows = ODD_ROWS + [d for d in docs if len(d[1]) < 4000] + [(30, "x y z x y z\nq\nq\n \n \n", "x"), (31, "a b a b a b", None)]
    got = data(q.quality_report(frame(spark, rows)), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == sorted(((i, *brute(t)) for i, t, _ in rows), key=str)


def test_model_is_a_distribution_and_bands_reject_junk(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = q.train(docs)
    rnd = np.random.default_rng(1)
    seen = model.logs[4][0] // np.uint32(q.CLASSES)
    for context in [*rnd.choice(seen, 20), *rnd.integers(0, q.CLASSES ** 3, 20)]:
        every = np.uint32(context) * np.uint32(q.CLASSES) + np.arange(q.CLASSES, dtype=np.uint32)
        assert abs(np.exp(model.score(every).astype(float)).sum() - 1) < 1e-3
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    junk = " ".join("xq" * 3 + str(i) + "zj<>" * 9 for i in range(400))
    kept = {r["doc_id"]: r["kept"] for r in q.quality_report(frame(spark, rows + [(9999, junk, "en")])).collect()}
    assert kept[9999] is False
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    long_enough = {i for i, t, _ in rows if i in good and brute(t)[0] >= 50 and 2 * brute(t)[4] <= brute(t)[0]}
    assert all(kept[i] for i in long_enough)


def test_band_catches_junk_and_keeps_good_texts(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    judged = q.quality_report(spark.read.parquet(f"{sf}/documents.parquet")).where("NOT base_failed")
    seen = judged.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("quality", "kept").collect()
    kept = {quality: [r["kept"] for r in seen if r["quality"] == quality] for quality in (0, 1)}
    print({k: (len(v), v.count(False)) for k, v in kept.items()})
    assert kept[0].count(False) > len(kept[0]) / 2
    assert kept[1].count(False) <= len(kept[1]) / 100


def test_keep_good_and_empty_table(spark):
    df = frame(spark, ODD_ROWS)
    out = q.keep_good(df)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [4]
    assert q.quality_report(frame(spark, [])).count() == 0
    assert q.keep_good(frame(spark, [])).count() == 0


def test_characters_of_a_class_keep_their_own_probability(spark):
    """Also beyond the 16-bit code points, which have no place among the letters, digits and white space of ASCII."""
    assert set(q._CLASS[0x10000:]) == set(range(48, 64)) and len(q._CLASS) == 0x110000
    a = 0x1F600
    b = next(i for i in range(a + 1, 0x20000) if q._CLASS[i] == q._CLASS[a])
    model = q.train(frame(spark, [(1, chr(a) * 60 + chr(b) * 3 + "text", "x")]))
    common, rare = q._log_ppl([(chr(c) * 30).encode() for c in (a, b)], model)
    assert rare - common > 2
    for c in range(q.SHARED, q.CLASSES):
        assert abs(np.exp(model.within[q._CLASS == c].astype(float)).sum() - 1) < 1e-3


def brute_ppl(texts, text):
    """Mean negative log probability under 4-grams of folded characters, backing off to the class model that ``below`` gives."""
    *texts, text = (re.sub("[\t-\r]", " ", re.sub("[0-9]", "0", re.sub("[A-Z]", lambda m: m[0].lower(), t))) for t in [*texts, text])
    grams = Counter(w[i:i + 4] for t in texts for w in ["   " + t] for i in range(len(t)))
    n1, n2, n3, n4 = (sum(n == k for n in grams.values()) for k in range(1, 5))
    y = n1 / (n1 + 2 * n2)
    d = [min(max(v, 0.05), most) for v, most in ((1 - 2 * y * n2 / n1, 0.95), (2 - 3 * y * n3 / n2 if n2 else 1.0, 1.9), (3 - 4 * y * n4 / n3 if n3 else 1.5, 2.9))]
    total, left = Counter(), Counter()
    for g, n in grams.items():
        total[g[:3]] += n
        left[g[:3]] += d[min(n, 3) - 1]

    def p(g, below):
        if not total[g[:3]]:
            return below
        return ((grams[g] - d[min(grams[g], 3) - 1] if grams[g] else 0) + left[g[:3]] * below) / total[g[:3]]

    return lambda below: -np.mean([np.log(p(("   " + text)[i:i + 4], below(("   " + text)[i:i + 4]))) for i in range(len(text))])


def test_ngrams_are_of_characters_not_of_their_classes(spark, monkeypatch):
    """Two characters of one class differ in what follows them and in what they follow, also in another slice and beyond 16 bits."""
    for a, limit in ((0x430, q.SLICE), (0x1F600, 7)):
        monkeypatch.setattr(q, "SLICE", limit)
        b = next(i for i in range(a + 1, 0x20000) if q._CLASS[i] == q._CLASS[a])
        texts = [f"{chr(a)}xyz " * 40 + f"{chr(b)}uvw " * 40, "Other Words, 12 of them; UPPER and lower."]
        model = q.train(frame(spark, [(i, t, "x") for i, t in enumerate(texts)]))
        assert (len(model.slices) > 1) == (limit == 7)
        same, other = q._log_ppl([(f"{x}xyz " * 9).encode() for x in (chr(a), chr(b))], model)
        assert other - same > 0.5

        def below(gram):
            code = 0
            for c in gram:
                code = code * q.CLASSES + int(q._CLASS[ord(c)])
            return float(np.exp(model.score(np.array([code], np.uint32))[0].astype(float) + model.within[ord(gram[-1])]))

        for text in (texts[0], texts[1], f"{chr(b)}xyz and 3 New"):
            assert abs(q._log_ppl([b"", text.encode(), b"zz"], model)[1] - brute_ppl(texts, text)(below)) < 1e-4
