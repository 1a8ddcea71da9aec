"""The registered ``opN_<name>`` queries and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetspark.llm import byte_bpe, chosen_path, conversation_repair, decontaminate, html_text, quality, ranked_search, recurrent_lm, secrets, substrings, surrogates, token_counts, toxicity
from fleetspark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


#: Key of the registered queries' surrogates; a production run passes its own secret.
SURROGATE_KEY = b"registered query"


@query("op1_pii_surrogates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.replace_personal_data(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    n = F.aggregate(F.map_values("entities_by_kind"), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", "text", n.alias("n_entities"))


@query("op2_recurrent_lm")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score_documents(table(spark, sf_dir, "documents"))


@query("op3_html_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"), ["page_id", "url"])


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents")).drop("found")


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tok

    return byte_bpe.encode_decode(table(spark, sf_dir, "documents"), tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN)


@query("op7_ngram_jaccard_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_report(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op10_decontaminate")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op11_ranked_search")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build_index(table(spark, sf_dir, "documents"))
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"))


@query("op12_token_counts")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tok

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tok.path("byte_bpe_50k.json"))


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = conversation_repair.Repair(conversation_repair.damage(table(spark, sf_dir, "conversations"))).summary
    return found.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


SQL["op10_decontaminate"] = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + 12], ' ') AS t
  FROM item, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS u(i) WHERE len(w) > 0),
size AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM doc, size, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
hit AS (SELECT r, i, place.n, item FROM place JOIN win ON win.t = place.t AND win.n = place.n),
word AS (SELECT r, count(DISTINCT j) AS n_hit FROM hit, unnest(range(i, i + n)) AS u(j) GROUP BY r),
names AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN names USING (r)
"""


SQL["op11_ranked_search"] = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
total AS (SELECT count(*) FILTER (len(t) > 0) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM doc),
item AS (
  SELECT row_number() OVER () AS q, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM benchmark),
asked AS (SELECT q, item_id, unnest(t) AS term FROM item),
occurs AS (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM doc),
posting AS (SELECT r, doc_id, n, term, count(*) AS tf FROM occurs WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
           FROM (SELECT term, count(*) AS df FROM posting GROUP BY term), total),
scored AS (
  SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN posting USING (term) JOIN weight USING (term), total GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id, r) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""


def _repair_sql() -> str:
    """Plain forward dynamic programming, one row of every conversation per step; a way is [cost and audit, repaired text]."""
    def way(state: str, cost: str, letter: str, turn: str = "''") -> str:
        return (f"CASE WHEN {state} IS NOT NULL THEN [printf('%09d', CAST(left({state}[1], 9) AS BIGINT) + {cost}) || substr({state}[1], 10) "
                f"|| '{letter}', {state}[2] || {turn}] END")

    def least(*ways: str) -> str:
        return f"list_min(list_filter([{', '.join(ways)}], lambda x : x IS NOT NULL))"

    line = "chr(10) || {} || ':' || {}"
    user, assistant = line.format("'user'", "''"), line.format("'assistant'", "''")
    text = "w.text"
    keep, rerole_u, rerole_a = (line.format(r, text) for r in ("w.role", "'user'", "'assistant'"))
    more = "(CASE WHEN w.kind = 'truncated' THEN 3 ELSE 0 END)"
    stays = "w.kind IN ('fine', 'truncated')"

    def row(state: str, sources: list[str], initial: str, rerole: str | None) -> str:
        kept = [f"CASE WHEN {stays} AND left(w.role, 1) = '{initial}' THEN {way(s, more, 'K', keep)} END" for s in sources]
        again = [f"CASE WHEN {stays} THEN {way(s, f'(3 + {more})', 'R', rerole)} END" for s in sources] if rerole else []
        return least(way(state, "4", "D"), *kept, *again)

    inserted = lambda tail: (
        f"SELECT conv, i, n0, ns, nu2, {least('na', way('nu2', '3', 'I', assistant))} AS na2 FROM ("
        f"SELECT *, {least('nu', way('n0', '3', 'I', user), way('ns', '3', 'I', user), way('na', '3', 'I', user))} AS nu2 FROM ({tail}))")
    step = (f"SELECT p.conv, p.i + 1 AS i, {way('p.n0', '4', 'D')} AS n0, {row('p.ns', ['p.n0'], 's', None)} AS ns, "
            f"{row('p.nu', ['p.n0', 'p.ns', 'p.na'], 'u', rerole_u)} AS nu, {row('p.na', ['p.nu'], 'a', rerole_a)} AS na "
            "FROM path p JOIN conv_rows w ON w.conv = p.conv AND w.i = p.i + 1")
    return rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b : CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x : CAST(ord(x) AS BIGINT)) AS key
  FROM conversations),
fated AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), key), lambda c, b : xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fate
  FROM keyed, crc_table),
convs AS (SELECT row_number() OVER () AS conv, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
damaged AS (
  SELECT conv, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated JOIN convs ON convs.conv_id IS NOT DISTINCT FROM fated.conv_id WHERE fate <> 0),
conv_rows AS (
  SELECT conv, turn, role, text, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 'duplicate'
              WHEN regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'fine' ELSE 'truncated' END AS kind
  FROM damaged),
faults AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (kind = 'blank') AS blank,
         count(*) FILTER (kind = 'duplicate') AS duplicate, count(*) FILTER (kind = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM (SELECT *, lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) || left(role, 1) AS pair FROM conv_rows) GROUP BY conv),
path(conv, i, n0, ns, nu, na) AS (
  {inserted("SELECT conv, CAST(0 AS BIGINT) AS i, ['000000000', ''] AS n0, CAST(NULL AS VARCHAR[]) AS ns, CAST(NULL AS VARCHAR[]) AS nu, CAST(NULL AS VARCHAR[]) AS na FROM convs")}
  UNION ALL
  {inserted(step)}),
ends AS (SELECT conv, i, {least('n0', 'na')} AS best FROM path)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(left(best[1], 9) AS BIGINT) AS cost, substr(best[1], 10) AS audit, sha256(substr(best[2], 2)) AS repaired_sha256
FROM convs LEFT JOIN faults USING (conv) JOIN ends ON ends.conv = convs.conv AND ends.i = coalesce(n, 0)
"""


SQL["op13_conversation_repair"] = _repair_sql()
