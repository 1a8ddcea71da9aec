"""Corpus pipeline: raw documents to encoded training texts in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; between
stages the documents are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetspark.llm import byte_bpe, chosen_path, decontaminate, quality, surrogates
from fleetspark.llm.common import shared_table, table
from fleetspark.llm.queries import SURROGATE_KEY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays, the one with the smallest id."""
    return chosen_path.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark contaminates go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates; n_chars follows the text."""
    out = surrogates.replace_personal_data(docs, SURROGATE_KEY, count_col=None)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    import public_tokenizers as tok

    return byte_bpe.encode_decode(docs, tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN, with_ids=True)


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard_join", near_duplicates), ("decontamination", decontamination),
          ("pii_surrogates", personal_data), ("byte_bpe", byte_level_bpe)]

#: The stages hold models and hashes that SQL cannot express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
