"""Files and documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_text(lines: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """One text file per task, or more if a task holds more than ``rows_per_file`` rows."""
    writer = lines.write.mode("errorifexists")
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def write_delimited(df: DataFrame, path: str, columns: Sequence[str] | None = None, sep: str = ",") -> None:
    (df.select(*columns) if columns else df).write.mode("errorifexists").option("sep", sep).csv(path)


def as_document(df: DataFrame, columns: Sequence[str]) -> Column:
    """A JSON document whose fields are all text."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]))


def write_documents(df: DataFrame, key: str, columns: Sequence[str], path: str) -> None:
    """Documents for an index loader: (key, document) rows as JSON lines."""
    df.select(F.col(key).cast("string").alias("doc_key"), as_document(df, columns).alias("source")).write.json(path)
