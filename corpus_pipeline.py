"""A training corpus from raw documents: one operator after another, each stage stored.

Every stage works on all rows that the one before kept. Stages but the last return the
columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from leafmill.llm.decontaminate import without_contaminated
from leafmill.llm.language import known_language, learn_languages
from leafmill.llm.line_dedup import dedup_lines
from leafmill.llm.near_duplicates import keep_one_per_group
from leafmill.llm.packing import pack_documents
from leafmill.llm.tables import Workspace, scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and those that fit none of the labelled languages.

    Null and empty texts go, repeated rows are judged alike, an empty table stays empty.
    """
    return known_language(docs, learn_languages(docs, with_none=True))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines found in ten different texts or more out of all texts.

    Copies of one text count once here, as the next stage is there to remove them. All
    documents stay, if need be with an empty text; ``n_chars`` follows the text. A null text is
    empty; repeated rows stay, each without the lines. An empty table stays empty.
    """
    kept = dedup_lines(docs, min_docs=10, min_chars=1, distinct_texts=True)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast("bigint"))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 over five-word shingles stays.

    Of repeated rows one stays; texts without words all stay. An empty table stays empty.
    """
    return keep_one_per_group(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item go.

    A null text has no words and stays; repeated rows go or stay together. Without items, or
    without documents, nothing changes.
    """
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=10)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens; a null or empty text is one separator, an empty table no rows."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

# A trained network, union-find and tokenising are beyond SQL; tests hold every stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back.

    A stage's own tables, and its input, are deleted once its output is written; what the last
    stage reads stays, as its result is not written here.
    """
    work = Workspace(spark, "corpus")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch():
            docs = work.put(stage(spark, docs, sf_dir), name)
        if before is not None:
            work.drop(before)
        before = docs
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
