"""Benchmark decontamination with DataFrame functions only.

Windows of 13 normalised words of the benchmark items form a hash set; every
document's words are scanned against it and hits are verified word for word.

* Words: A-Z lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``
  (digits, a-z and everything outside ASCII).
* A window: 13 consecutive words of an item; an item of fewer words, but not
  none, is one window.
* Each window is filed under its longest word (the first of these). A document
  position whose word files windows is a candidate for them; the candidate
  words are cut out and compared in full.
* A document word inside any occurrence is hit; the document is contaminated if
  ``n_hit > 0 and 20 * n_hit >= n_words``.

Plan: one scan of the documents; each row is exploded into its words inside the
scan stage and dropped there unless its word files windows, so only hits and one
row per document are shuffled. The window table is broadcast only while its
rows and bytes, item ids included and counted before equal windows are merged,
are at most ``BROADCAST_WINDOWS`` and ``BROADCAST_BYTES``. Beyond it the
documents' windows meet the benchmark's by a 64-bit hash in a shuffle join; what
meets is cut out of its text again and joined on its words, and the item ids are
joined to these hits last, so no list is longer than its document or its result.

Defined results: a null or empty text has no words and is never contaminated;
null benchmark texts have no window; repeated rows each get their own result;
items that repeat a text all count; an item with a null id hits, but is not
listed; other columns are ignored. A kept column with the name of a result
column (``RESULTS``) gives way to it; ``drop_contaminated`` returns the input's
columns whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Words of a window.
WINDOW = 13
#: Window rows up to which the window table is broadcast.
BROADCAST_WINDOWS = 200_000
#: Bytes up to which it is (window texts, their longest words and item ids).
BROADCAST_BYTES = 32 << 20

#: Columns that ``decontaminate`` adds.
RESULTS = ("n_words", "spans", "items", "n_hit", "contaminated")

_SEPARATORS = "".join(chr(c) for c in [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Normalised words of a text, in order (null text: none)."""
    # \x00 ends a match string of translate, so it is replaced on its own
    plain = F.translate(F.replace(text, F.lit("\x00"), F.lit(" ")), _UPPER + _SEPARATORS[1:],
                        _UPPER.lower() + " " * (len(_SEPARATORS) - 1))
    return F.array_remove(F.split(F.coalesce(plain, F.lit("")), " "), "")


def window_rows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """A row per window of each item: anchor (longest word), back (its place in the window), n (words), window (text), item."""
    items = benchmark.select(_col(item_col).cast("string").alias("item"), words(_col(text_col)).alias("w")).where(F.size("w") > 0)
    cut = items.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))).alias("at"))
    cut = cut.select("item", F.slice("w", F.col("at"), F.lit(size)).alias("w"))
    longest = F.array_max(F.transform("w", lambda x, i: F.struct(F.length(x).alias("len"), (-i).alias("at"), x.alias("word"))))
    return cut.withColumn("top", longest).select(F.col("top.word").alias("anchor"), (-F.col("top.at")).alias("back"), F.size("w").alias("n"),
                                                 F.array_join("w", " ").alias("window"), "item")


def benchmark_windows(rows: DataFrame) -> DataFrame:
    """``window_rows`` with equal windows merged and their items as a list."""
    return rows.groupBy("anchor", "back", "n", "window").agg(F.collect_set("item").alias("items"))


def _col(name: str) -> Column:
    """A column by its whole name, which may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def _hit_words(spans: Column) -> Column:
    """Words covered by spans (start, stop), which may overlap."""
    empty = F.struct(F.lit(0).alias("stop"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        F.array_sort(spans), empty,
        lambda acc, s: F.struct(F.greatest(acc["stop"], s["stop"]).alias("stop"),
                                (acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(acc["stop"], s["start"]))).alias("n")),
        lambda acc: acc["n"])


def _near(places: DataFrame, windows: DataFrame) -> DataFrame:
    """Places whose word files windows that can lie around them, and place 0."""
    return (places.join(windows, (F.col("_word") == F.col("anchor")) & (F.col("_at") > F.col("back")), "left")
                  .where((F.col("_at") == 0) | F.col("anchor").isNotNull()))


def _cut(words_col: str, at: Column, n: Column) -> Column:
    return F.array_join(F.slice(words_col, at, n), " ")


def _span(start: Column, n: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), (start + n).cast("int").alias("stop"))


def find_hits(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text",
              item_col: str = "item_id", size: int = WINDOW) -> DataFrame:
    """One row per input row: ``keep`` columns, n_words, spans (hit word ranges), items (their ids, sorted)."""
    return _found(docs, benchmark, keep, text_col, item_col, size).select("_keep.*", "n_words", "spans", "items")


def _found(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str, item_col: str, size: int) -> DataFrame:
    """One row per input row: _keep (struct), n_words, spans, items."""
    rows = window_rows(benchmark, item_col, "text", size)
    n, held, sizes = rows.agg(F.count("*"), F.sum(F.octet_length("window") + F.octet_length("anchor") + F.coalesce(F.octet_length("item"), F.lit(0))),
                              F.collect_set("n")).first()
    kept = [_col(c).alias(c) for c in keep]
    base = docs.select(F.struct(*kept).alias("_keep") if kept else F.struct(F.lit(0).alias("_none")).alias("_keep"), words(_col(text_col)).alias("_w"),
                       F.xxhash64(*[_col(c) for c in keep], _col(text_col)).alias("_key"))
    if n <= BROADCAST_WINDOWS and (held or 0) <= BROADCAST_BYTES:
        return _hits_in_scan(base, benchmark_windows(rows))
    return _hits_by_shuffle(base, rows, sorted(sizes))


def _hits_in_scan(base: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows of bounded size are broadcast, and a place's words are compared in the scan stage."""
    # element 0 stands for the document itself, so that rows without a hit stay
    places = base.select(F.monotonically_increasing_id().alias("_row"), "_keep", "_w").select(
        "_row", "_keep", "_w", F.posexplode(F.concat(F.array(F.lit("")), F.col("_w"))).alias("_at", "_word"))
    near = _near(places, F.broadcast(windows)).where((F.col("_at") == 0) | (_cut("_w", F.col("_at") - F.col("back"), F.col("n")) == F.col("window")))
    rows = near.select("_row", F.when(F.col("_at") == 0, F.col("_keep")).alias("_keep"), F.when(F.col("_at") == 0, F.size("_w")).alias("_n"),
                       F.when(F.col("_at") > 0, _span(F.col("_at") - F.col("back") - 1, F.col("n"))).alias("_span"), F.col("items").alias("_items"))
    found = rows.groupBy("_row").agg(
        F.max("_n").cast("long").alias("n_words"), F.first("_keep", ignorenulls=True).alias("_keep"),
        F.collect_set("_span").alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("items"))
    return found.select("_keep", "n_words", "spans", "items")


def _hits_by_shuffle(base: DataFrame, rows: DataFrame, sizes: list[int]) -> DataFrame:
    """Windows of any number: the documents' windows of the same ``sizes`` meet them by hash, then by their words.

    Rows of equal key and text have equal hits, so they share them."""
    hashes = rows.select(F.xxhash64("window").alias("hash")).distinct()
    places = base.select("_key", "_w", F.posexplode("_w").alias("_at", "_word")).select("_key", "_w", (F.col("_at") + 1).alias("_at"))
    cuts = places.select("_key", "_w", "_at", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("n")).where(F.col("_at") + F.col("n") - 1 <= F.size("_w"))
    met = cuts.select("_key", "_at", "n", F.xxhash64(_cut("_w", F.col("_at"), F.col("n"))).alias("hash")).join(hashes, "hash", "left_semi")
    lists = met.select("_key", "_at", "n").distinct().groupBy("_key").agg(F.collect_list(F.struct("_at", "n")).alias("_near"))
    near = base.join(lists, "_key").select("_key", "_w", F.explode("_near").alias("c")).select(
        "_key", (F.col("c._at") - 1).alias("start"), "c.n", _cut("_w", F.col("c._at"), F.col("c.n")).alias("window")).distinct()
    true = near.join(rows.select("window").distinct(), "window", "left_semi")
    spans = true.groupBy("_key").agg(F.collect_set(_span(F.col("start"), F.col("n"))).alias("spans"))
    listed = true.select("_key", "window").distinct().join(rows.where("item IS NOT NULL").select("window", "item").distinct(), "window")
    items = listed.select("_key", "item").distinct().groupBy("_key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return base.select("_key", "_keep", F.size("_w").cast("long").alias("n_words")).join(spans, "_key", "left").join(items, "_key", "left").select(
        "_keep", "n_words", F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _verdict(found: DataFrame) -> DataFrame:
    found = found.withColumn("n_hit", _hit_words(F.col("spans")))
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text",
                  item_col: str = "item_id", size: int = WINDOW) -> DataFrame:
    """``find_hits`` with the verdict: n_hit and contaminated."""
    keep = [c for c in keep if c.lower() not in RESULTS]
    return _verdict(_found(docs, benchmark, keep, text_col, item_col, size)).select(*[_col("_keep").getField(c).alias(c) for c in keep], *RESULTS)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", size: int = WINDOW) -> DataFrame:
    """The input rows, with their columns as they are, that the benchmark does not contaminate."""
    found = _verdict(_found(docs, benchmark, docs.columns, text_col, item_col, size))
    return found.where("NOT contaminated").select(*[_col("_keep").getField(c).alias(c) for c in docs.columns])


def remove_spans(text: Column, spans: Column) -> Column:
    """The normalised words of a text outside hit spans, joined by one space."""
    return F.array_join(F.filter(words(text), lambda w, i: ~F.exists(spans, lambda s: (s["start"] <= i) & (i < s["stop"]))), " ")
