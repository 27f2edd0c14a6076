"""The corpus pipeline: documents are filtered by quality, cleaned of repeated lines, deduplicated, decontaminated, encoded.

Every stage works on all that its predecessor kept. Null texts count as empty ones, an empty table goes through as one, and
columns beside ``doc_id``, ``text``, ``n_chars`` are carried along, whatever their names. ``run`` writes the result of each stage but the last to the shared
folder and reads it again, so that a later stage, or an executor that replaces a lost one, doesn't repeat the earlier ones.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import bpe, decontaminate, factorization, lines, order_minhash
from clientele.llm.common import table
from clientele.llm.queries import RANKS
from clientele.session import scratch

#: Documents that score below are rejected.
QUALITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine takes for good ones; it learns from the labelled among the given documents.

    Every row is scored by itself, rows of empty and null text by their statistics; repeated rows get the same score.
    """
    model = factorization.train(docs, table(spark, sf_dir, "labels"))
    return factorization.score(docs, model, keep=tuple(docs.columns), above=QUALITY)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand, but for one character, at an earlier place; ``n_chars`` follows.

    Every row stays, also one that has no line left. Null texts stay null; rows that repeat id and text keep the same lines;
    lines of a null id come before all others.
    """
    clean = lines.dedup(docs)
    kind = dict(docs.dtypes)["n_chars"]
    return clean.withColumn("n_chars", F.length("text").cast(kind))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one of smallest id.

    Texts without words are copies only if they are the same (null and empty are). Rows that share an id are one document;
    rows without an id stay.
    """
    return order_minhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item. Null and empty texts hold none; null and empty items have none."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, encoded and decoded again: count and digests, a row for each row."""
    return bpe.digests(docs, RANKS, public_tokenizers.PATTERN).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", encoding),
]

#: The classifier, the near copies and the tokens can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        place = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return STAGES[-1][1](spark, docs, sf_dir)
