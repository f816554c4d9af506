"""Top-n per group, rank with ties, global top-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each group; the order must break all ties.

    The limit on row_number is applied in every task before the shuffle (WindowGroupLimit), so a
    group sends at most n rows per task, however large it is.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return numbered.where(F.col(rank) <= n)


def top_ranked(
    df: DataFrame, group: Sequence[str], value: str, max_rank: int, rank: str = "rank"
) -> DataFrame:
    """Rows of rank 1..max_rank by descending value; equal values share a rank and are all kept.

    Ties can be as many as the rows, so rows are not sorted per group. Each group is reduced to its
    max_rank highest distinct values with their row counts, which settle the ranks of all rows.
    """
    highest = top_n(df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_ties")), group, [F.desc(value)], max_rank, "_nth")
    above = Window.partitionBy(*group).orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        highest.withColumn(rank, (F.coalesce(F.sum("_ties").over(above), F.lit(0)) + 1).cast("int"))
        .where(F.col(rank) <= max_rank)
        .select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col(value).alias("_g_value"), rank)
    )
    same = F.col(value).eqNullSafe(F.col("_g_value"))
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return df.join(ranks, same).drop("_g_value", *[f"_g_{g}" for g in group])


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The n first rows over all; each task keeps n (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)
