"""Which rows came too late for their windows, decided from arrival order and event time alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durations import micros
from tidemark.operators.sequences import Measure, Slices, by_number, running


def tag_late(
    df: DataFrame,
    arrival: str,
    ts: str,
    size: str | int,
    slide: str | int,
    disorder: str | int,
    lateness: str | int,
    arrivals_per_slice: int = 1_000_000,
    tie: str | None = None,
    seen_before: int | None = None,
) -> DataFrame:
    """Adds ``is_late``: true if even the last window of the row was closed when it arrived.

    The watermark is the highest event time among earlier arrivals less the disorder bound; a window
    is closed once the watermark reaches its end plus the allowed lateness. ``seen_before`` is the
    highest event time, in microseconds, of arrivals that are not in the table.
    """
    seen = Measure("_highest", "max", F.unix_micros(F.col(ts)))
    ranked = running(df, [], [arrival, *([tie] if tie else [])], by_number(arrival, arrivals_per_slice), [seen], exclusive=True)
    last_end = Slices(F.unix_micros(F.col(ts)), micros(slide)).start() + micros(size)
    closed_at = last_end + micros(lateness) + micros(disorder)
    highest = F.greatest("_highest", F.lit(seen_before).cast("bigint"))
    return ranked.withColumn("is_late", F.coalesce(closed_at <= highest, F.lit(False))).drop("_highest")
