"""Time windows: tumbling, sliding, session, and counted windows."""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from tidemark.durations import micros, spark_interval
from tidemark.operators.sequences import HEAVY_ROWS, MERGE, Measure, Slices, apart, by_time, islands, sliced_running


EXACT = (IntegralType, DecimalType)


def epoch(ts: str | Column) -> Column:
    """Whole epoch seconds of a timestamp."""
    return F.unix_seconds(F.col(ts) if isinstance(ts, str) else ts)


def tumbling(
    df: DataFrame, ts: str, size: str | int, keys: Sequence[str], aggregates: Sequence[Column]
) -> DataFrame:
    """Aggregates per key and window of fixed size; without keys, one row per window."""
    grouped = df.groupBy(F.window(ts, spark_interval(size)).alias("window"), *keys).agg(*aggregates)
    return grouped.withColumn("window_end", F.col("window.end"))


def sliding(
    df: DataFrame, ts: str, size: str | int, slide: str | int, keys: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Aggregates per key and sliding window; columns are the keys, ``window_end`` and the measures.

    A stream goes through Spark's own window(), twice: tumbling panes first, and windows over those.
    A table is first reduced to panes (the greatest
    length dividing size and slide), so that the size/slide-fold growth applies to pane totals and
    not to rows. Panes travel to at most two blocks of one window length, and are spread over
    their windows only there, so the shuffle carries two copies of a pane however small the slide.
    """
    merged = [MERGE[m.merge](m.name).alias(m.name) for m in measures]
    if df.isStreaming:
        parts = [MERGE[m.merge](m.part).alias(m.name) for m in measures]
        pane = F.window(ts, f"{gcd(micros(size), micros(slide))} microseconds").alias("pane")
        panes = df.groupBy(pane, *keys).agg(*parts).withColumn("pane_time", F.window_time("pane"))
        window = F.window("pane_time", spark_interval(size), spark_interval(slide)).alias("window")
        return panes.groupBy(window, *keys).agg(*merged).withColumn("window_end", F.col("window.end"))
    length, step = micros(size), micros(slide)
    pane_length = gcd(length, step)
    start = Slices(F.unix_micros(F.col(ts)), pane_length).start()
    panes = (
        df.select(*keys, start.alias("_pane"), *[m.part.alias(m.name) for m in measures])
        .groupBy(*keys, "_pane")
        .agg(*merged)
    )
    pane = F.col("_pane")
    # Windows start at multiples of the step; a pane lies in those starting in (pane - length, pane].
    down = lambda p: p - F.pmod(p, F.lit(step))
    up = lambda p: p + F.pmod(-p, F.lit(step))
    block_length = -(-length // step) * step
    block_of = lambda p: p - F.pmod(p, F.lit(block_length))
    placed = panes.withColumns({"_from": up(pane + (pane_length - length)), "_to": down(pane)})
    if length < step:  # some panes are in no window
        placed = placed.where(F.col("_from") <= F.col("_to"))
    blocks = F.sequence(block_of(F.col("_from")), block_of(F.col("_to")), F.lit(block_length))
    spread = placed.withColumn("_block", F.explode(blocks)).repartition(*keys, "_block")
    begin = F.greatest("_from", "_block")
    stop = F.least(F.col("_to") + step, F.col("_block") + block_length)
    parts = df.select(*[m.part.alias(m.name) for m in measures]).schema
    if all(m.merge == "sum" and isinstance(f.dataType, EXACT) and not f.nullable for m, f in zip(measures, parts, strict=True)):
        totals = _by_changes(spread, keys, begin, stop, F.col("_block") + block_length, step, [m.name for m in measures])
    else:
        totals = (
            spread.withColumn("_start", F.explode(F.sequence(begin, stop - step, F.lit(step))))
            .groupBy(*keys, "_block", "_start")
            .agg(*merged)
        )
    return totals.select(
        *keys, F.timestamp_micros(F.col("_start") + length).alias("window_end"), *[m.name for m in measures]
    )


def _by_changes(
    spread: DataFrame, keys: Sequence[str], begin: Column, stop: Column, end: Column, step: int, names: Sequence[str]
) -> DataFrame:
    """Sums per window start from where panes come in and drop out, without one row per pane and window.

    A pane adds its value at the first start it counts for and takes it back after the last. Their
    running sum in a block holds from one change to the next, and only there is it spread over the
    starts. Subtraction has to be exact, so this serves whole numbers without
    nulls only.
    """
    change = lambda at, sign: F.struct(
        at.alias("_start"), F.lit(sign).cast("bigint").alias("_panes"), *[(F.col(n) * sign).alias(n) for n in names]
    )
    values = ["_panes", *names]
    block = [*keys, "_block"]
    changes = (
        spread.select(*block, end.alias("_end"), F.inline(F.array(change(begin, 1), change(stop, -1))))
        .where(F.col("_start") < F.col("_end"))
        .groupBy(*block, "_end", "_start")
        .agg(*[F.sum(v).alias(v) for v in values])
    )
    in_order = Window.partitionBy(*block).orderBy("_start")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    following = F.coalesce(F.lead("_start").over(in_order), F.col("_end"))
    runs = changes.withColumns({v: F.sum(v).over(so_far) for v in values} | {"_next": following})
    starts = F.sequence(F.col("_start"), F.col("_next") - step, F.lit(step))
    return runs.where(F.col("_panes") > 0).withColumn("_start", F.explode(starts))


def sessions(
    df: DataFrame, ts: str, gap: str | int, keys: Sequence[str], tie: str, measures: Sequence[Measure],
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Windows that close after a silence longer than the gap; they end one gap after the last row."""
    if df.isStreaming:
        window = F.session_window(ts, spark_interval(gap)).alias("window")
        parts = [MERGE[m.merge](m.part).alias(m.name) for m in measures]
        return (
            df.groupBy(window, *keys)
            .agg(*parts)
            .withColumns({"session_start": F.col("window.start"), "session_end": F.col("window.end")})
        )
    quiet = micros(gap)
    silent = lambda a, b: F.unix_micros(b[ts]) - F.unix_micros(a[ts]) > quiet
    width = max(quiet, micros("1 hour"))
    bounds = [Measure("session_start", "min", F.col(ts)), Measure("session_end", "max", F.col(ts))]
    found = islands(df, keys, [ts, tie], by_time(ts, width // 1_000_000, heavy_rows), silent, [ts], [*bounds, *measures])
    return found.withColumn("session_end", F.timestamp_micros(F.unix_micros("session_end") + quiet))


def counted(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slices: Slices,
    size: int,
    slide: int,
    measures: Sequence[Measure],
) -> DataFrame:
    """Windows over the last ``size`` rows of a key, fired after every ``slide`` rows.

    The first firings hold fewer rows; rows after the last full slide do not fire.
    """
    merged = [MERGE[m.merge](m.name).alias(m.name) for m in measures]

    def whole(df: DataFrame) -> DataFrame:
        by_key = Window.partitionBy(*keys).orderBy(*order)
        last = by_key.rowsBetween(1 - size, Window.currentRow)
        numbered = df.withColumns(
            {"_nth": F.row_number().over(by_key)} | {m.name: MERGE[m.merge](m.part).over(last) for m in measures}
        )
        firing = F.floor(F.col("_nth") / slide).cast("bigint").alias("firing")
        return numbered.where(F.col("_nth") % slide == 0).select(*keys, firing, *[m.name for m in measures])

    def sliced(df: DataFrame) -> DataFrame:
        """Rows are numbered across slices and added up in panes, each of which serves several firings."""
        numbered = sliced_running(df, keys, order, slices, [Measure("_nth", "sum", F.lit(1).cast("bigint"))])
        pane_rows = gcd(size, slide)
        pane = F.floor((F.col("_nth") - 1) / pane_rows).cast("bigint").alias("_pane")
        panes = (
            numbered.select(*keys, pane, *[m.part.alias(m.name) for m in measures])
            .groupBy(*keys, "_pane")
            .agg(*merged, F.count(F.lit(1)).alias("_filled"))
        )
        per_slide, per_size = slide // pane_rows, size // pane_rows
        # Firing f covers panes up to f * per_slide - 1; it happens once that last pane is full.
        first = F.floor(F.col("_pane") / per_slide).cast("bigint") + 1
        last = F.floor((F.col("_pane") + per_size) / per_slide).cast("bigint")
        closes = (F.pmod("_pane", F.lit(per_slide)) == per_slide - 1) & (F.col("_filled") == pane_rows)
        fired = (
            panes.withColumn("_closes", F.when(closes, first))
            .where(first <= last)
            .withColumn("firing", F.explode(F.sequence(first, last)))
            .groupBy(*keys, "firing")
            .agg(*merged, F.max("_closes").alias("_closed"))
        )
        return fired.where(F.col("_closed") == F.col("firing")).drop("_closed")

    return apart(df, keys, slices, whole, sliced)
