"""Projection, filtering, flattening, splitting into branches, and joining branches up again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import java_split

# Endings of static resources that page rankings leave out.
STATIC_ENDINGS = ("css", "js", "png", "ico")


def words(df: DataFrame, text: str, out: str = "word") -> DataFrame:
    """One row per space-separated word of every line of a text column."""
    parts = F.flatten(F.transform(F.split(text, "\\n"), lambda line: java_split(line, " ")))
    return df.withColumn(out, F.explode(parts))


def flatten_mixed(df: DataFrame, column: str, out: str, element: str = "bigint") -> DataFrame:
    """One row per element of JSON values that are either one scalar or a list of them."""
    is_list = F.ltrim(F.col(column)).startswith("[")
    as_list = F.when(is_list, F.col(column)).otherwise(F.concat(F.lit("["), F.col(column), F.lit("]")))
    return df.withColumn(out, F.explode(F.from_json(as_list, f"array<{element}>")))


def first_match(df: DataFrame, cases: Sequence[tuple[Column, Column]], out: str) -> DataFrame:
    """One row per element of the array of the first case that holds; rows without one yield none."""
    (condition, values), *rest = cases
    chosen = F.when(condition, values)
    for condition, values in rest:
        chosen = chosen.when(condition, values)
    return df.withColumn(out, F.explode(chosen))


def without_static(df: DataFrame, url: str) -> DataFrame:
    """Leaves out static resources, told by the ending of the URL."""
    return df.where(~F.col(url).rlike(rf"\.({'|'.join(STATIC_ENDINGS)})$"))


def tag_branch(df: DataFrame, condition: Column, yes: str, no: str, out: str = "branch") -> DataFrame:
    """Splits a table in one pass: rows are tagged, each consumer filters its branch."""
    return df.withColumn(out, F.when(condition, yes).otherwise(no))


def connect(parts: Sequence[DataFrame]) -> DataFrame:
    """Brings differing row shapes to one; absent columns become null. Duplicates are kept."""
    first, *rest = parts
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def parse_or_quarantine(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts text columns; ``is_valid`` is false where a text that is present does not parse."""
    parsed = {c: F.col(c).try_cast(t) for c, t in types.items()}
    valid = F.lit(True)
    for c in types:
        valid = valid & (F.col(c).isNull() | parsed[c].isNotNull())
    return df.withColumn("is_valid", valid).withColumns(parsed)


def hash_sample(df: DataFrame, name: Column, fraction: float) -> DataFrame:
    """Rows of which the first 32 bits of their name's MD5 lie under the fraction; no shuffle, no seed of a partition."""
    number = F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.where(number < fraction * 4294967296)
