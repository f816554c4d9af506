"""Event patterns by key: neighbours, repeated matches, followed-by with a timeout, bursts.

A pattern bounded by ``within`` needs only rows that far away, so rows are grouped by key and time
slice with a halo of that length; no key is ever sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durations import micros
from tidemark.operators.chains import chained_windows
from tidemark.operators.sequences import (
    HEAVY_ROWS,
    MERGE,
    SLICE,
    Measure,
    apart,
    by_time,
    islands,
    sliced_running,
    with_halo,
)


def _slice_seconds(width: str | int, within: str | int) -> int:
    """Slices at least four times as long as their halo, so that copies stay few."""
    return max(micros(width), 4 * micros(within)) // 1_000_000


def consecutive(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    matches: Column,
    times: int,
    within: str | int,
    inclusive: bool = True,
    width: str | int = "1 hour",
) -> DataFrame:
    """``times`` matching rows directly after each other in a key, the last at most ``within`` after the first.

    One row per occurrence: keys, ``first_ts``, ``last_ts``. Overlapping occurrences all count. The
    bound itself is allowed unless ``inclusive`` is False.
    """
    here = Window.partitionBy(*keys, SLICE).orderBy(ts, tie)
    near = with_halo(
        df.select(*keys, ts, tie, matches.alias("_match")), ts, _slice_seconds(width, within), within
    )
    steps = range(1, times)
    span = F.unix_micros(ts) - F.unix_micros("first_ts")
    bound = span <= micros(within) if inclusive else span < micros(within)
    all_match = F.col("_match")
    for n in steps:
        all_match = all_match & F.coalesce(F.col(f"_match_{n}"), F.lit(False))
    return (
        near.withColumns({f"_match_{n}": F.lag("_match", n).over(here) for n in steps})
        .withColumn("first_ts", F.lag(ts, times - 1).over(here))
        .where(F.col("_own") & all_match & bound)
        .select(*keys, "first_ts", F.col(ts).alias("last_ts"))
    )


def followed_by(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    opens: Column,
    closes: Column,
    within: str | int,
    width: str | int = "1 hour",
) -> DataFrame:
    """For each opening row the first closing row of its key at its time or later, less than ``within`` later.

    One row per opening row: keys, ``opened_ts``, the tie column, and ``closed_ts`` (null when the
    time ran out). Rows of another kind may lie in between. Null keys belong to nobody: such an
    opening row stays open.
    """
    limit = micros(within)
    for key in keys:
        closes = closes & F.col(key).isNotNull()
    near = with_halo(
        df.select(*keys, ts, tie, opens.alias("_opens"), closes.alias("_closes")).where("_opens OR _closes"),
        ts,
        _slice_seconds(width, within),
        0,
        within,
    )
    later = Window.partitionBy(*keys, SLICE).orderBy(F.desc(ts)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    next_close = F.min(F.when(F.col("_closes"), F.col(ts))).over(later)
    in_time = F.unix_micros("_next") - F.unix_micros(ts) < limit
    return (
        near.withColumn("_next", next_close)
        .where(F.col("_own") & F.col("_opens"))
        .select(*keys, F.col(ts).alias("opened_ts"), tie, F.when(in_time, F.col("_next")).alias("closed_ts"))
    )


def rising_runs(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str, at_least: str | int, width: str | int = "1 hour",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Runs in which the value never falls, lasting ``at_least``: keys, start, end, number of rises.

    A run starts at its first rise: after a fall, rows at the same level only wait for one. The
    first row of a key counts as a rise.
    """
    slices = by_time(ts, width, heavy_rows)
    rises = lambda before, row: F.coalesce(row[value] > before[value], F.lit(True))
    measures = [
        Measure("run_start", "min", lambda before, row: F.when(rises(before, row), row[ts])),
        Measure("run_end", "max", F.col(ts)),
        Measure("n_rises", "sum", lambda before, row: rises(before, row).cast("bigint")),
    ]
    falls = lambda a, b: b[value] < a[value]
    runs = islands(df.select(*keys, ts, tie, value), keys, [ts, tie], slices, falls, [value], measures)
    return runs.where(F.unix_micros("run_end") - F.unix_micros("run_start") >= micros(at_least))


def bursts(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    fails: Column,
    within: int,
    at_least: int = 2,
    width: str | int = "1 hour",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Failure counts in windows that open at a first failure and are called off by a success.

    A failure opens a window of ``within`` seconds unless one is open; a success before its end
    cancels it; at its end ``at_least`` failures raise a warning. Times are whole seconds. A row
    more than ``within`` after its predecessor always opens a new window, so unbroken stretches of
    failures are independent. What a stretch holds after its first window is counted per second and cut
    into windows slice by slice.
    """
    slices = by_time(ts, _slice_seconds(width, within), heavy_rows)
    second = lambda c: F.unix_seconds(c)

    def marked(df: DataFrame, group: Sequence[str]) -> DataFrame:
        """Whether a row goes on a stretch, and when a success follows it."""
        w = Window.partitionBy(*group).orderBy(ts, tie)
        near = second(F.col(ts)) - F.lag(second(F.col(ts))).over(w) <= within
        return df.withColumns(
            {
                "_follows": F.coalesce(F.lag("_fail").over(w) & near, F.lit(False)),
                "_cancel": F.when(~F.lead("_fail").over(w), F.lead(second(F.col(ts))).over(w)),
            }
        )

    starts = F.when(F.col("_follows"), 0).otherwise(1).cast("bigint")
    measures = [
        Measure("_stretch", "sum", F.when(F.col("_fail"), starts)),
        Measure("_first", "max", F.when(F.col("_fail") & ~F.col("_follows"), second(F.col(ts)))),
    ]

    def whole(df: DataFrame) -> DataFrame:
        so_far = Window.partitionBy(key).orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
        numbered = marked(df, [key]).withColumns({m.name: MERGE[m.merge](m.part).over(so_far) for m in measures})
        return numbered.where("_fail")

    def sliced(df: DataFrame) -> DataFrame:
        near = marked(with_halo(df, ts, slices.width // 1_000_000, within, within), [key, SLICE])
        failed = near.where("_own AND _fail").drop(SLICE, "_own")
        return sliced_running(failed, [key], [ts, tie], slices, measures)

    called_off = F.coalesce(F.col("_cancel") <= F.col("first_second") + within, F.lit(False))
    warns = (F.col("n_fails") >= at_least) & ~called_off

    def found(failed: DataFrame) -> DataFrame:
        """The first window of every stretch, and the windows cut from what is left of long ones."""
        at = second(F.col(ts))
        in_first = at <= F.col("_first") + within
        first = (
            failed.where(in_first)
            .groupBy(key, "_stretch", F.col("_first").alias("first_second"))
            .agg(F.max(at).alias("last_second"), F.count(F.lit(1)).alias("n_fails"), F.max("_cancel").alias("_cancel"))
        )
        per_second = failed.where(~in_first).groupBy(key, "_stretch", at.alias("first_second")).agg(
            F.count(F.lit(1)).alias("_n"), F.max("_cancel").alias("_called")
        )
        totals = {"last_second": F.max("first_second"), "n_fails": F.sum("_n"), "_cancel": F.max("_called")}
        width_s = max(_slice_seconds(width, within), 2 * within + 2)
        cut = chained_windows(per_second, [key, "_stretch"], "first_second", within, width_s, totals)
        return first.unionByName(cut.select(*first.columns)).where(warns).select(key, "first_second", "last_second", "n_fails")

    return found(apart(df.select(key, ts, tie, fails.alias("_fail")), [key], slices, whole, sliced))
