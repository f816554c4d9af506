"""Aggregations: counts and sums by key, largest row, running forms, distinct users per window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.scalars import polynomial_hash
from tidemark.operators.sequences import Measure, Slices, running


def count_by(df: DataFrame, keys: Sequence[str | Column], out: str = "n") -> DataFrame:
    """Rows per key; combined in every task before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def sum_by(df: DataFrame, keys: Sequence[str | Column], value: Column, out: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def as_map(counts: DataFrame, key: str, value: str, part: Column, out: str = "counts") -> DataFrame:
    """Counts as maps, one per part of the key space, so no single map has to hold every key."""
    entries = F.collect_list(F.struct(key, value))
    return counts.groupBy(part.alias("part")).agg(F.map_from_entries(entries).alias(out))


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The table unchanged, and aggregates over it that are there once an action has run on it."""
    observation = Observation()
    return df.observe(observation, *[c.alias(name) for name, c in metrics.items()]), observation


def branch_counts(df: DataFrame, keys: Sequence[str], branches: dict[str, Column]) -> DataFrame:
    """How many rows of each key fall in each branch, in one pass."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(name) for name, c in branches.items()])


def max_row(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """The whole row with the largest value per key; of equal values the earliest."""
    earliest = F.struct(F.col(value), *[-F.col(o) for o in order])
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*others), earliest).alias("_row")).select(*keys, "_row.*")


def running_max_row(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], slices: Slices, prefix: str = "max_"
) -> DataFrame:
    """Per row the row with the largest value of its key so far; of equal values the earliest."""
    others = [c for c in df.columns if c not in keys]
    part = F.struct(F.col(value), *[(-F.col(o)).alias(f"_late_{o}") for o in order], F.struct(*others).alias("row"))
    best = running(df, keys, order, slices, [Measure("_best", "max", part)])
    return best.withColumns({f"{prefix}{c}": F.col(f"_best.row.{c}") for c in others}).drop("_best")


def distinct_per_window(windowed: DataFrame, window: str, user: str, out: str = "uv") -> DataFrame:
    """Exact distinct users per window.

    A table is deduplicated by (window, user) and then counted, so no window sits in one task. A
    stream may not use count(distinct), and drops duplicates within the watermark instead.
    """
    if windowed.isStreaming:
        return windowed.dropDuplicates([window, user]).groupBy(window).agg(F.count(F.lit(1)).alias(out))
    return windowed.groupBy(window).agg(F.count_distinct(user).alias(out))


BITMAP_BITS = 1 << 29


def bitmap_offset(user: Column) -> Column:
    """A user's bit in a map of 2^29 bits."""
    return polynomial_hash(user.cast("string"), 61, BITMAP_BITS)


def bitmap_distinct(windowed: DataFrame, window: str, user: str, out: str = "uv") -> DataFrame:
    """Distinct users as a 2^29-bit map with one hash function counts them: collisions count once."""
    return distinct_per_window(windowed.withColumn("_bit", bitmap_offset(F.col(user))), window, "_bit", out)


def bitmap_store(windowed: DataFrame, window: str, user: str) -> DataFrame:
    """The bit maps themselves, in 4 KB pieces that can be kept and merged across runs."""
    bit = bitmap_offset(F.col(user))
    return (
        windowed.select(window, bit.alias("_bit"))
        .groupBy(window, F.bitmap_bucket_number("_bit").alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("bits"))
    )


def bitmap_store_count(store: DataFrame, window: str, out: str = "uv") -> DataFrame:
    merged = store.groupBy(window, "piece").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(window).agg(F.sum(F.bitmap_count("bits")).alias(out))


SKETCH_LOG2 = 14


def sketch_bound(log2_cells: int = SKETCH_LOG2) -> float:
    """The relative error that a merged sketch stays within in 99.7 of 100 cases: three standard errors."""
    return 3 * 1.04 / 2 ** (log2_cells / 2)


def sketch_store(panes: DataFrame, keys: Sequence[str | Column], user: str, log2_cells: int = SKETCH_LOG2) -> DataFrame:
    """A sketch of the distinct users per key, to be kept and merged across runs, keys and windows.

    It takes at most 2^log2_cells bytes however many users there are, and is built in every task before
    the shuffle, so a hot key costs no more than another. Null users count nothing, as in count(distinct).
    """
    known = F.col(user).cast("string")
    return panes.groupBy(*keys).agg(F.hll_sketch_agg(known, log2_cells).alias("sketch"))


def sketch_count(store: DataFrame, keys: Sequence[str | Column], out: str = "uv") -> DataFrame:
    """Distinct users per key over all sketches of it, each user once, within ``sketch_bound``."""
    merged = store.groupBy(*keys).agg(F.hll_union_agg("sketch", False).alias("_sketch"))
    return merged.withColumn(out, F.hll_sketch_estimate("_sketch")).drop("_sketch")
