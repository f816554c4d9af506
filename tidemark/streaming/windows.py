"""Windowed streams: second-stage rankings, distinct users, and joins of two streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import gcd

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.durations import micros, spark_interval
from tidemark.operators.aggregates import bitmap_offset, distinct_per_window
from tidemark.operators.joins import reached_slices, slice_width, within_reach
from tidemark.operators.ranking import top_n
from tidemark.operators.sequences import SLICE, Measure, with_halo
from tidemark.operators.windows import sliding
from tidemark.streaming.processors import (
    FirstClosing,
    PaneSums,
    PatternMatches,
    Retractions,
    apply_processor,
    flagged_keys,
    in_buckets,
    times,
)


def window_counts(
    stream: DataFrame, ts: str, delay: str | int, size: str | int, slide: str | int | None, keys: Sequence[str]
) -> DataFrame:
    """Counts per key and window of a stream whose rows are at most ``delay`` late.

    Sliding windows are summed from panes, so a pane and not a row goes to each of its windows.
    """
    marked, count = stream.withWatermark(ts, spark_interval(delay)), Measure("n", "sum", F.lit(1).cast("bigint"))
    if slide is not None and slide != size:
        return sliding(marked, ts, size, slide, keys, [count]).drop("window_end")
    return marked.groupBy(F.window(ts, spark_interval(size)).alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))


def sliding_sums(
    rows: DataFrame, ts: str, size: str | int, slide: str | int, keys: Sequence[str], measures: dict[str, Column]
) -> DataFrame:
    """Sums per key and sliding window of a stream with a watermark, however small the slide is.

    Rows are first added up in panes, in every task before the shuffle. A key's finished panes then
    stay in state for one window length, and a window is the one before plus the panes that came in
    less those that dropped out. Taking off has to be exact, so the measures must be whole numbers;
    a null counts nothing. Null keys are a key. The window in which a sum is empty is left out.
    """
    fields = {f.name: f.dataType for f in rows.select(*keys, *[m.alias(n) for n, m in measures.items()]).schema}
    inexact = [n for n in measures if not isinstance(fields[n], IntegralType)]
    if inexact:
        raise ValueError(f"sums that are taken off again must be of whole numbers: {inexact}")
    length, step = micros(size), micros(slide)
    if step > length:
        raise ValueError("a slide longer than the window leaves rows out; use it on tables")
    pane = gcd(length, step)
    window = F.window(ts, f"{pane} microseconds").alias("pane")
    sums = [F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(n) for n, m in measures.items()]
    panes = rows.groupBy(window, *keys).agg(*sums).select(*keys, F.window_time("pane").alias("ts"), *measures)
    named = ", ".join(f"{k} {panes.schema[k].dataType.simpleString()}" for k in keys)
    return apply_processor(panes, keys, PaneSums(named, list(measures), length, step, pane))


def ranked_windows(key: str, n: int) -> Callable[[DataFrame], DataFrame]:
    """Second stage for ``run_batches_to_table``: the n highest counts of each finished window."""

    def rank(counts: DataFrame) -> DataFrame:
        ended = counts.select(F.col("window.end").alias("window_end"), key, "n")
        return top_n(ended, ["window_end"], [F.desc("n"), F.asc(key)], n)

    return rank


def distinct_users(
    stream: DataFrame, ts: str, delay: str | int, size: str | int, user: str, bitmap: bool = False
) -> DataFrame:
    """Distinct users per tumbling window, exact or as a one-hash bit map counts them."""
    windowed = stream.withWatermark(ts, spark_interval(delay)).select(
        F.window(ts, spark_interval(size)).alias("window"),
        (bitmap_offset(F.col(user)) if bitmap else F.col(user)).alias("_user"),
    )
    return distinct_per_window(windowed, "window", "_user").select(F.col("window.end").alias("window_end"), "uv")


def retractions(rows: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Totals per key as a stream of changes: ``change`` is -1 on the total that no longer holds and 1 on the new one.

    Adding up ``change`` by key and total leaves each key's last total. Rows are added up in every
    Arrow batch before the shuffle, so a hot key sends a row a batch. Measures are whole numbers, a
    null counts nothing, and null keys are a key.
    """
    names = list(measures)
    plain = rows.select(*keys, *[F.coalesce(m.cast("bigint"), F.lit(0).cast("bigint")).alias(n) for n, m in measures.items()])
    marked, flags = flagged_keys(plain, keys)
    by = [*flags, *flags.values()]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by(by, use_threads=False).aggregate([(n, "sum") for n in names])
            yield from sums.select([*by, *[f"{n}_sum" for n in names]]).rename_columns([*by, *names]).to_batches()

    fitted = marked.select(*by, *names)
    named = ", ".join(f"{k} {plain.schema[k].dataType.simpleString()}" for k in keys)
    return in_buckets(fitted.mapInArrow(add_up, fitted.schema), flags, Retractions(named, names), "none")


def replayed_changes(changes: DataFrame) -> DataFrame:
    """The table that a stream of changes leaves: what was told more often than taken back."""
    rest = [c for c in changes.columns if c != "change"]
    return changes.groupBy(*rest).agg(F.sum("change").alias("_times")).where("_times > 0").drop("_times")


def first_closing(
    rows: DataFrame, key: str, ts: str, opens: Column, closes: Column, within: str | int, width: str | int = "1 hour"
) -> DataFrame:
    """For each opening row of a stream the first closing time of its key less than ``within`` later, or null.

    The stream needs a watermark and the columns key, ``ts`` and ``event_id``. A key is cut into time slices, and a
    closing row goes to the slices in which it may be waited for, so the state of a hot key is spread and no pairs are
    made. Openings without a closing row come out when their time has run out. Null keys belong to nobody, and
    their openings come out at once.
    """
    flagged = rows.select(key, F.col(ts).alias("ts"), "event_id", opens.alias("opens"), closes.alias("closes"))
    nobodys = flagged.where(F.col("opens") & F.col(key).isNull())
    nobodys = nobodys.select(key, F.col("ts").alias("opened_ts"), "event_id", F.lit(None).cast("timestamp").alias("closed_ts"))
    flagged = flagged.where(F.col(key).isNotNull())
    seconds = max(micros(width), 4 * micros(within)) // 1_000_000
    near = with_halo(flagged.where("opens OR closes"), "ts", seconds, 0, within).where("_own OR closes")
    near = near.withColumnsRenamed({SLICE: "slice", "_own": "own"})  # processors lose names that begin with _
    kind = rows.schema[key].dataType.simpleString()
    return apply_processor(near, [key, "slice"], FirstClosing(key, kind, micros(within))).union(nobodys)


def consecutive(
    rows: DataFrame, key: str, ts: str, matches: Column, n: int, within: str | int, inclusive: bool = True
) -> DataFrame:
    """``n`` matching rows of a stream directly after each other in a key, as the operator of this name tells them."""
    flagged = rows.select(key, F.col(ts).alias("ts"), "event_id", matches.alias("match")).where(F.col(key).isNotNull())
    kind = rows.schema[key].dataType.simpleString()
    return apply_processor(flagged, key, PatternMatches(key, kind, times("match", n), micros(within), inclusive))


def reconciled(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, lower: str | int, upper: str | int
) -> DataFrame:
    """Matched pairs and unmatched rows of two watermarked streams, as the operator ``reconcile`` tells them.

    Both joins also match on a time slice, so a hot key's rows wait in many state partitions. A join
    tells the unmatched rows of the side that keeps its slice, while the other goes to the slices where
    it may be wanted; so each side has a join of its own, and only the first tells the pairs.
    """
    width, near = slice_width(lower, upper), within_reach(left_ts, right_ts, lower, upper)
    back, ahead = -micros(upper), -micros(lower)

    def join(kept: DataFrame, kept_ts: str, sent: DataFrame, sent_ts: str, low: int, high: int) -> DataFrame:
        at = F.unix_micros(F.col(kept_ts))
        reached = reached_slices(F.unix_micros(F.col(sent_ts)), f"{low} microseconds", f"{high} microseconds", width)
        own = kept.withColumn("_own", at - F.pmod(at, F.lit(width)))
        copies = sent.withColumnRenamed(key, "_key").withColumn("_slice", F.explode(reached))
        met = near & (F.col(key) == F.col("_key")) & (F.col("_own") == F.col("_slice"))
        return own.join(copies, met, "left_outer")

    pays = join(left, left_ts, right, right_ts, back, ahead)
    pays = pays.withColumn("branch", F.when(F.col("_key").isNull(), "unmatched_pay").otherwise("matched"))
    receipts = join(right, right_ts, left, left_ts, micros(lower), micros(upper)).where(F.col("_key").isNull())
    receipts = receipts.withColumn("branch", F.lit("unmatched_receipt"))
    columns = [key, *[c for side in (left, right) for c in side.columns if c != key], "branch"]
    return pays.select(columns).unionByName(receipts.select(columns))
