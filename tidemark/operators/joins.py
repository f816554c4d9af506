"""Joins: interval join, reconciliation, per-window join, membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durations import micros
from tidemark.operators.sequences import SLICE, Slices


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    lower: str | int,
    upper: str | int,
) -> DataFrame:
    """Pairs of equal keys with right_ts in [left_ts + lower, left_ts + upper], both ends included.

    The sides are also joined on a time slice of the interval's length: the right side keeps its slice,
    the left side goes to the two slices its interval can touch. So a hot key is cut by time instead
    of being matched with itself as a whole, and on streams its rows wait in many state partitions.
    """
    width = slice_width(lower, upper)
    reached = reached_slices(F.unix_micros(F.col(left_ts)), lower, upper, width)
    sliced = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    sliced = sliced.withColumn("_r_slice", Slices(F.unix_micros(F.col(right_ts)), width).start())
    met = within_reach(left_ts, right_ts, lower, upper) & (F.col(SLICE) == F.col("_r_slice"))
    for k in keys:
        met = met & (F.col(k) == F.col(f"_r_{k}"))
    joined = left.withColumn(SLICE, F.explode(reached)).join(sliced, met).drop(SLICE, "_r_slice", *[f"_r_{k}" for k in keys])
    others = [c for c in joined.columns if c not in keys]
    return joined.select(*keys, *others)


def slice_width(lower: str | int, upper: str | int) -> int:
    """Slices as long as the interval: a row reaches two of them, and at times one."""
    return max(micros(upper) - micros(lower), micros("1 second"))


def reached_slices(position: Column, lower: str | int, upper: str | int, width: int) -> Column:
    """The slices in which partners between ``lower`` and ``upper`` of a row may lie."""
    begin = lambda p: p - F.pmod(p, F.lit(width))
    return F.sequence(begin(position + micros(lower)), begin(position + micros(upper)), F.lit(width))


def within_reach(left_ts: str, right_ts: str, lower: str | int, upper: str | int) -> Column:
    """The condition on times, as Spark reads from it how long a stream's rows must wait."""
    return F.expr(
        f"{right_ts} >= {left_ts} + interval {micros(lower)} microseconds "
        f"AND {right_ts} <= {left_ts} + interval {micros(upper)} microseconds"
    )


def unmatched(
    rows: DataFrame,
    partners: DataFrame,
    keys: Sequence[str],
    ts: str,
    partner_ts: str,
    lower: str | int,
    upper: str | int,
    width: str | int = "1 hour",
) -> DataFrame:
    """Rows without any partner of the same key in [ts + lower, ts + upper]. A row with a null key has none.

    No pairs are formed. Rows are placed at the end of their interval among the partners; the
    latest partner up to there is in the interval or none is. Only partners at most one interval
    back matter, so (key, time slice) with a copied edge is enough.
    """
    low, high = micros(lower), micros(upper)
    step = max(micros(width), high - low)
    begin = lambda p: p - F.pmod(p, F.lit(step))
    asked = rows.withColumns({"_at": F.unix_micros(F.col(ts)) + high, "_is_row": F.lit(1)})
    asked = asked.withColumn(SLICE, begin(F.col("_at")))
    at = F.unix_micros(F.col(partner_ts))
    given = (
        partners.dropna(subset=list(keys)).select(*keys, at.alias("_at"), at.alias("_seen"), F.lit(0).alias("_is_row"))
        .withColumn(SLICE, F.explode(F.sequence(begin(F.col("_at")), begin(F.col("_at") + (high - low)), F.lit(step))))
    )
    so_far = Window.partitionBy(*keys, SLICE).orderBy("_at", "_is_row").rowsBetween(Window.unboundedPreceding, 0)
    latest = F.max("_seen").over(so_far)
    return (
        asked.unionByName(given, allowMissingColumns=True)
        .withColumn("_latest", latest)
        .where((F.col("_is_row") == 1) & (F.col("_latest").isNull() | (F.col("_latest") < F.col("_at") - (high - low))))
        .select(*rows.columns)
    )


def reconcile(
    pays: DataFrame,
    receipts: DataFrame,
    keys: Sequence[str],
    pay_ts: str,
    receipt_ts: str,
    lower: str | int,
    upper: str | int,
) -> DataFrame:
    """Matched pairs and both unmatched sides, told apart by ``branch``."""
    matched = interval_join(pays, receipts, keys, pay_ts, receipt_ts, lower, upper)
    lone_pays = unmatched(pays, receipts, keys, pay_ts, receipt_ts, lower, upper)
    lone_receipts = unmatched(receipts, pays, keys, receipt_ts, pay_ts, f"{-micros(upper)} microseconds", f"{-micros(lower)} microseconds")
    return (
        matched.withColumn("branch", F.lit("matched"))
        .unionByName(lone_pays.withColumn("branch", F.lit("unmatched_pay")), allowMissingColumns=True)
        .unionByName(lone_receipts.withColumn("branch", F.lit("unmatched_receipt")), allowMissingColumns=True)
    )


def window_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, size: str | int
) -> DataFrame:
    """All pairs of equal keys that fall in the same tumbling window (one micro-batch's join)."""
    width = micros(size)
    a = left.withColumn("_window", Slices(F.unix_micros(F.col(left_ts)), width).start())
    b = right.withColumn("_window", Slices(F.unix_micros(F.col(right_ts)), width).start())
    return (
        a.join(b, [*keys, "_window"])
        .withColumn("window_end", F.timestamp_micros(F.col("_window") + width))
        .drop("_window")
    )


def members_of(df: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a top-n list. The list is cut to n rows, so broadcasting it is safe."""
    return df.join(F.broadcast(top.select(key)), key, "left_semi")
