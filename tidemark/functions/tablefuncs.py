"""Table function: a text split into (word, length) rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import java_split


def split_rows(df: DataFrame, column: str, separator: str) -> DataFrame:
    """Joins each row with its parts: adds ``word`` and ``length``, one row per part."""
    return df.withColumn("word", F.explode(java_split(column, separator))).withColumn("length", F.length("word"))


def register(spark: SparkSession, separator: str = "_") -> None:
    """SQL name: split_words(text), used as ``FROM t, LATERAL split_words(t.c)``. Null has no parts."""
    literal = separator.replace("\\", "\\\\").replace("'", "\\'")
    pattern = re.escape(separator).replace("\\", "\\\\").replace("'", "\\'")
    kept = f"regexp_replace(s, '(?:{pattern})+$', '')" if len(separator) > 1 else f"rtrim('{literal}', s)"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION split_words(s STRING) RETURNS TABLE(word STRING, length INT)
        RETURN SELECT word, length(word) FROM (SELECT explode(
            if({kept} <> '' OR s = '', split({kept}, '{pattern}'), CAST(array() AS ARRAY<STRING>))) AS word)
        """
    )
