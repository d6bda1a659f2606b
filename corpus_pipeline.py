"""A training-corpus pipeline: good documents, one of each near-duplicate group, no benchmark text, mixed, as tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinetab.llm import queries
from cinetab.llm.fmindex import drop_contaminated
from cinetab.llm.minhash import drop_near_duplicates
from cinetab.llm.mixing import repeat_documents
from cinetab.llm.quality import keep_good
from cinetab.llm.shared import Chain
from cinetab.llm.tokens import token_output


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as good, with all their columns.

    Null, blank and very long texts are scored like others; repeated rows have one score and stay or go together.
    """
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates: five words, similarity of 0.8 or more.

    Rows without an id or without words stay; of rows that repeat id and text one stays. Texts are compared whole.
    """
    return drop_near_duplicates(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window; a contaminated document goes as a whole.

    Null and blank texts have no window and stay, repeated rows stay or go together, and whole texts are searched.
    """
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    A document that is taken in part comes once more if half of it or more is. Documents without words come as often as whole ones of their
    source; a null source is a source, and rows that repeat id and text come equally often.
    """
    return repeat_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32 of each copy, null ids first, equal ids by content."""
    return token_output(docs, queries.TOKENIZER)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: A learned classifier, a tokenizer and MinHash have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again before the next, then deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chain = Chain()
    for _, stage in STAGES[:-1]:
        docs = chain.step(stage, spark, docs, sf_dir)
    out = STAGES[-1][1](spark, docs, sf_dir)  # reads the token files alone from here on
    chain.end()
    return out
