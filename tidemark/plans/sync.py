"""Incremental synchronisation of a change log into a wide-row table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changes import apply_changes, wide_rows
from tidemark.sinks.keyed import merge_each_batch, read_keyed


def synchronised(changes: DataFrame, key: str, order: Sequence[str], family: str, columns: Sequence[str]) -> DataFrame:
    """The wide rows a change log leads to."""
    return wide_rows(apply_changes(changes, [key], order), key, family, columns)


def sync_each_batch(path: str, key: str, order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: merges changes into a keyed table of last images, deletions included.

    A deletion stays as the key's last image, so an older change arriving later does not undo it.
    """
    return merge_each_batch(path, [key], order, by_arrival=False)


def read_synchronised(
    spark: SparkSession, path: str, key: str, order: Sequence[str], family: str, columns: Sequence[str]
) -> DataFrame:
    images = read_keyed(spark, path, [key], order, by_arrival=False)
    return wide_rows(images.where(F.col("type") != "delete"), key, family, columns)
