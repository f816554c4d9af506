"""Login failures, payment timeouts, payment reconciliation, sensor monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.branch import tag_branch
from tidemark.operators.joins import interval_join, reconcile
from tidemark.operators.patterns import bursts, consecutive, followed_by, rising_runs
from tidemark.operators.sequences import HEAVY_ROWS, Measure, by_time, previous, running
from tidemark.operators.windows import counted

FAILED = "fail"


def login_failures(logins: DataFrame, times: int = 2, within: str = "2 seconds", inclusive: bool = True) -> DataFrame:
    """A user's failures directly after each other within a time: one warning per occurrence.

    The state-machine form allows the bound itself, the pattern form (``inclusive=False``) does not.
    """
    return consecutive(logins, ["user_id"], "ts", "event_id", F.col("status") == FAILED, times, within, inclusive)


def login_bursts(logins: DataFrame, within: int = 2, at_least: int = 2, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    failed = F.col("status") == FAILED
    return bursts(logins, "user_id", "ts", "event_id", failed, within, at_least, heavy_rows=heavy_rows)


def payment_timeouts(orders: DataFrame, within: str = "15 minutes") -> DataFrame:
    """Every created order, as paid in time or timed out: order, creation time, ``result``."""
    followed = followed_by(
        orders, ["order_id"], "ts", "event_id", F.col("event_type") == "create", F.col("event_type") == "pay", within
    )
    return with_result(followed, within)


def with_result(followed: DataFrame, within: str) -> DataFrame:
    ran_out = F.unix_millis(F.col("opened_ts") + F.expr(f"interval {within}"))
    result = F.when(F.col("closed_ts").isNotNull(), "payed").otherwise(F.concat(F.lit("timeout:"), ran_out))
    return followed.withColumn("result", result)


def matched_payments(pays: DataFrame, receipts: DataFrame, before: str = "3 seconds", after: str = "5 seconds") -> DataFrame:
    """Payments with their receipts: receipt time in [pay time - before, pay time + after]."""
    return interval_join(pays, receipts, ["tx_id"], "pay_ts", "receipt_ts", f"-{before}", after)


def reconciled_payments(
    pays: DataFrame, receipts: DataFrame, before: str = "3 seconds", after: str = "5 seconds"
) -> DataFrame:
    return reconcile(pays, receipts, ["tx_id"], "pay_ts", "receipt_ts", f"-{before}", after)


def temperature_branches(readings: DataFrame, limit: float = 30.0) -> DataFrame:
    return tag_branch(readings, F.col("temperature") > limit, "high", "low")


def temperature_jumps(
    readings: DataFrame, threshold: float = 10.0, width: str = "1 hour", heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Neighbouring readings of a sensor at least ``threshold`` apart."""
    pairs = previous(readings, ["id"], ["ts", "event_id"], by_time("ts", width, heavy_rows), {"temperature": "before"})
    return pairs.where(F.abs(F.col("temperature") - F.col("before")) >= threshold).select(
        "id", "ts", "before", F.col("temperature").alias("after")
    )


def temperature_rises(
    readings: DataFrame, at_least: str = "10 seconds", width: str = "1 hour", heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    return rising_runs(readings, ["id"], "ts", "event_id", "temperature", at_least, width, heavy_rows)


def reading_numbers(readings: DataFrame, width: str = "1 hour") -> DataFrame:
    """Each reading with its number within its sensor."""
    one = Measure("nth", "sum", F.lit(1).cast("bigint"))
    return running(readings, ["id"], ["ts", "event_id"], by_time("ts", width), [one])


def rolling_averages(
    readings: DataFrame, size: int = 10, slide: int = 2, width: str = "1 hour", heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Average of a sensor's last ``size`` readings after every ``slide`` readings."""
    parts = [Measure("_sum", "sum", F.col("temperature")), Measure("_n", "sum", F.lit(1).cast("bigint"))]
    fired = counted(readings, ["id"], ["ts", "event_id"], by_time("ts", width, heavy_rows), size, slide, parts)
    return fired.select("id", "firing", (F.col("_sum") / F.col("_n")).alias("avg_temp"))
