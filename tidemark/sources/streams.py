"""File-backed streams: how a socket, a queue of batches or a topic is replayed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """A folder (or one file) as a stream. One file per batch replays a queue one batch at a time; unset takes all."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def line_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of text arriving as files."""
    return file_stream(spark, path, "value string", "text", files_per_batch)
