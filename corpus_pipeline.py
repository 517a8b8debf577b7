"""From raw documents to packed sequences: five stages, each over all that the one before kept.

Every stage but the last gives rows with the columns of `documents`. Rows that a stage
rejects are gone for the next. Nulls: a null text is of unknown language and goes at the
second stage at the latest; null ids stay and are nobody's copies.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid.llm import chosen_path, concat_cut, language, pii, rule_quality
from pacegrid.llm.stages import staged

LEAST_LANGUAGE_SCORE = 0.5
TOKENIZER = "byte_bpe_50k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the labelled ones, scores 0.5 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rule_quality.good(docs, rule_quality.fit(docs, labels))


def keep_told(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with a score of at least 0.5."""
    return language.told(docs, language.fit(docs), LEAST_LANGUAGE_SCORE)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    return chosen_path.first_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars follows the new text.

    Null texts stay null with their n_chars; all rows stay, repeated ones and those with a null
    id too; an empty table gives no rows.
    """
    cleaned = pii.redact(docs)
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens.

    A null or empty text is its end id alone; null ids stay null; each repeated row is packed by
    itself; an empty table gives no pieces.
    """
    return concat_cut.pack_pieces(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", keep_good),
    ("language", keep_told),
    ("near_duplicates", keep_first),
    ("personal_data", redact),
    ("packing", pack),
]

# The models and the tokenizer have no SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage keeps is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs, _ = staged(docs, name)
    return docs
