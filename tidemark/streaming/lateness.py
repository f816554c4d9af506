"""Late rows of a stream as an output of their own. Spark itself drops them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.lateness import tag_late


def late_each_batch(path: str, ts: str, **lateness) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: writes every batch's rows, split by ``is_late``.

    The highest event time of each batch is kept next to them, one number per batch, so a row is
    judged by all earlier arrivals. A repeated batch overwrites its own folders.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen = None
        if number > 0:
            earlier = spark.read.schema("highest bigint, batch bigint").parquet(f"{path}/highest")
            seen = earlier.where(F.col("batch") < number).agg(F.max("highest")).first()[0]
        batch.agg(F.max(F.unix_micros(F.col(ts))).alias("highest")).write.mode("overwrite").parquet(
            f"{path}/highest/batch={number}"
        )
        tagged = tag_late(batch, ts=ts, seen_before=seen, **lateness)
        tagged.write.mode("overwrite").partitionBy("is_late").parquet(f"{path}/rows/batch={number}")

    return write


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows with ``is_late``; a filter on it reads only that side."""
    return spark.read.parquet(f"{path}/rows").drop("batch").withColumn("is_late", F.col("is_late").cast("boolean"))
