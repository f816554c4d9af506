"""The corpus pipeline: rules, near-duplicates, mix and token ids, over the documents table.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before has kept. Stages but the last return
the columns of documents; the last returns each document of the mix with its ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bytebpe, mixing, neardup, quality
from tidemark.llm.common import kept_table, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither their own rules nor their host's reject."""
    return quality.judge(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.deduplicate(docs.select(*COLUMNS)).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(mixing.with_size(docs.select(*COLUMNS), size="__size_of"), size="__size_of")
    times = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return mixed.filter("copies > 0").withColumn("copy", F.explode(times)).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether they decode to the text."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = bytebpe.encode(docs.select(*COLUMNS), ranks, public_tokenizers.PATTERN, decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return decoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("same"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("near-duplicates", keep_one_of_each),
    ("source mix", mix_sources),
    ("token ids", encode),
]

#: Sampling, rounding and byte-pair merging have no SQL; tests/llm compares with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = kept_table(docs, "stage")
    return docs
