"""What per-partition code computes, on explicit buckets instead of physical partitions.

Physical partitions depend on file splits and cluster size; a bucket is a function of the row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sequences import Measure, Slices, running


def bucket(column: str, n: int) -> Column:
    return F.pmod(F.col(column), F.lit(n))


def one_bucket(df: DataFrame, column: str, n: int, wanted: int) -> DataFrame:
    return df.where(bucket(column, n) == wanted)


def sum_of_maxima(df: DataFrame, column: str, n: int, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Maximum per bucket (and key), summed over the buckets (per key)."""
    maxima = df.groupBy(bucket(column, n).alias("_bucket"), *keys).agg(F.max(value).alias("_max"))
    return maxima.groupBy(*keys).agg(F.sum("_max").alias("sum_of_maxima"))


def salted_count(df: DataFrame, salt: Column, keys: Sequence[Column]) -> DataFrame:
    """Counts in two phases, first by key and salt.

    Plain groupBy().count() already combines in every task before the shuffle; the salted form is
    for callers that want the per-salt counts bounded as well.
    """
    salted = df.groupBy(*keys, salt.alias("_salt")).agg(F.count(F.lit(1)).alias("_n"))
    return salted.groupBy(*[c for c in salted.columns if c not in ("_salt", "_n")]).agg(F.sum("_n").alias("n"))


def numbered_in_bucket(df: DataFrame, column: str, n: int, slices: Slices, order: Sequence[str]) -> DataFrame:
    """How many rows of its bucket came up to each row: a per-subtask counter that survives restarts."""
    tagged = df.withColumn("bucket", bucket(column, n))
    return running(tagged, ["bucket"], order, slices, [Measure("nth", "sum", F.lit(1).cast("bigint"))])


def with_setup(df: DataFrame, open_: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """Per-task set-up around a batch function: ``open_`` runs once per task and returns the function."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work = open_()
        for batch in batches:
            yield work(batch)

    return df.mapInPandas(run, schema)


def redistribute(df: DataFrame, how: str, n: int | None = None, column: str | None = None) -> DataFrame:
    """Random, by key, or onto one task. The last is for final, small outputs only."""
    if how == "random":
        return df.repartition(n)
    if how == "key":
        return df.repartition(n, column) if n else df.repartition(column)
    if how == "one":
        return df.coalesce(1)
    raise ValueError(how)
