"""Change records and keyed upserts: the last image of each key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key. max_by is combined in every task, so a hot key costs nothing extra."""
    others = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*others), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*")


def apply_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str], kind: str = "type") -> DataFrame:
    """The table a change log leads to: last image per key, deleted keys left out."""
    return latest(changes, keys, order).where(F.col(kind) != "delete")


def upsert(
    current: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str], by_arrival: bool = True
) -> DataFrame:
    """Current rows, replaced where an update has their key, plus the new keys.

    An update replaces whatever is there, or only an older row if ``by_arrival`` is False. Both
    sides are aggregated together, so one shuffle serves the deduplication and the merge.
    """
    if not by_arrival:
        return latest(current.unionByName(updates), keys, order)
    aged = current.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    return latest(aged, keys, ["_new", *order]).drop("_new")


def wide_rows(df: DataFrame, key: str, family: str, columns: Sequence[str]) -> DataFrame:
    """(key, column family) rows as a wide-column store takes them."""
    return df.select(key, F.struct(*columns).alias(family))
