"""Operators over rows in order: running totals, previous rows, islands, bounded look-back.

A window function over one key sorts the whole key in one task, so a key holding a third of the
data would become one task's work. There are two ways out:

* When a row needs only rows at most some duration away, rows are cut into *slices* of fixed width
  and (key, slice) is the unit of work. ``with_halo`` copies the rows near a slice edge into the
  neighbouring slice: one shuffle, no join.
* When a row needs everything before it, the heaviest keys are told apart first. Their rows are cut
  into slices; each slice is reduced to one summary row (combined before the shuffle), the
  summaries are accumulated, and every slice gets one *carry row* put in front of its rows. All
  other keys go through the plain window function. Either way a row is shuffled once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durations import micros

SLICE = "_slice"
IS_ROW = "_is_row"
FAN = 4096

MERGE = {"sum": F.sum, "max": F.max, "min": F.min}


# A key with fewer rows is never cut, and neither is one outside the MOST_HEAVY heaviest: such a key
# holds less than one row in MOST_HEAVY of the whole, which is no more than an average task does.
HEAVY_ROWS = 1_000_000
MOST_HEAVY = 10_000


@dataclass(frozen=True)
class Slices:
    """Cuts rows by a whole-number position that never falls along the row order."""

    position: Column
    width: int
    heavy_rows: int = HEAVY_ROWS
    column: str | None = None

    def check(self, order: Sequence[str]) -> None:
        """Slices in another order than the rows would change results for heavy keys only."""
        if self.column is not None and (not order or order[0] != self.column):
            raise ValueError(f"rows are cut by {self.column} but ordered by {list(order)}")

    def start(self) -> Column:
        return self.position - F.pmod(self.position, F.lit(self.width))


def by_time(ts: str = "ts", width: str | int = "1 hour", heavy_rows: int = HEAVY_ROWS) -> Slices:
    return Slices(F.unix_micros(F.col(ts)), micros(width), heavy_rows, ts)


def by_number(column: str, width: int, heavy_rows: int = HEAVY_ROWS) -> Slices:
    return Slices(F.col(column).cast("bigint"), width, heavy_rows, column)


@dataclass(frozen=True)
class Measure:
    """A running value: its name, how parts merge (sum, max, min), and each row's part.

    For ``islands`` the part may be a function of the row before and the row itself, given by name.
    """

    name: str
    merge: str
    part: Column | Callable[[dict[str, Column], dict[str, Column]], Column]

    def of(self, before: dict[str, Column], row: dict[str, Column]) -> Column:
        return self.part(before, row) if callable(self.part) and not isinstance(self.part, Column) else self.part

    @property
    def looks_back(self) -> bool:
        return not isinstance(self.part, Column)

    def with_first(self, part: Column) -> Column:
        """This value together with the part of a row that was left out."""
        here = F.col(self.name)
        both = {"sum": here + part, "max": F.greatest(here, part), "min": F.least(here, part)}[self.merge]
        return F.coalesce(both, here, part)


def heavy_keys(df: DataFrame, keys: Sequence[str], at_least: int) -> DataFrame:
    """Hashes of the keys with most rows, MOST_HEAVY at most."""
    counts = df.groupBy(F.xxhash64(*keys).alias("_heavy")).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") >= at_least).orderBy(F.desc("_rows"), "_heavy").limit(MOST_HEAVY).select("_heavy")


def apart(
    df: DataFrame,
    keys: Sequence[str],
    slices: Slices,
    whole: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Rows of heavy keys go through ``sliced``, all others through ``whole``.

    Keys are told apart by hash, nulls included; one that collides with a heavy key merely goes the
    other way. The list is cut to MOST_HEAVY numbers and has a definite order, so it may be
    broadcast, and both parts see the same list.
    """
    if not keys:
        return sliced(df)
    heavy = F.broadcast(heavy_keys(df, keys, slices.heavy_rows))
    same = F.xxhash64(*keys) == F.col("_heavy")
    return whole(df.join(heavy, same, "left_anti")).unionByName(sliced(df.join(heavy, same, "left_semi")))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slices: Slices,
    measures: Sequence[Measure],
    exclusive: bool = False,
) -> DataFrame:
    """Adds running values by key, up to and including the row (or before it, if exclusive).

    Without keys all rows are one sequence; the summaries of its slices are then sliced once more.
    """
    slices.check(order)
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    return apart(
        df,
        keys,
        slices,
        lambda rows: rows.withColumns({m.name: MERGE[m.merge](m.part).over(frame) for m in measures}),
        lambda rows: sliced_running(rows, keys, order, slices, measures, exclusive, 1 if keys else 2),
    )


def sliced_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slices: Slices,
    measures: Sequence[Measure],
    exclusive: bool = False,
    levels: int = 1,
) -> DataFrame:
    names = [m.name for m in measures]
    rows = df.withColumns({SLICE: slices.start()} | {m.name: m.part for m in measures})
    totals = rows.groupBy(*keys, SLICE).agg(*[MERGE[m.merge](m.name).alias(m.name) for m in measures])
    if levels == 1:
        earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        carries = totals.select(
            *keys, SLICE, *[MERGE[m.merge](m.name).over(earlier).alias(m.name) for m in measures]
        )
    else:
        outer = "_outer"
        parts = [Measure(m.name, m.merge, F.col(m.name)) for m in measures]
        coarse = Slices(F.col(outer), slices.width * FAN)
        carries = sliced_running(
            totals.withColumnRenamed(SLICE, outer), keys, [outer], coarse, parts, True, levels - 1
        ).withColumnRenamed(outer, SLICE)
    carries = carries.where(reduce(or_, [F.col(n).isNotNull() for n in names]))
    here = Window.partitionBy(*keys, SLICE).orderBy(IS_ROW, *order).rowsBetween(
        Window.unboundedPreceding, -1 if exclusive else 0
    )
    return (
        _put_in_front(rows, carries)
        .withColumns({m.name: MERGE[m.merge](m.name).over(here) for m in measures})
        .where(F.col(IS_ROW) == 1)
        .drop(SLICE, IS_ROW)
    )


def _put_in_front(rows: DataFrame, carries: DataFrame) -> DataFrame:
    return rows.withColumn(IS_ROW, F.lit(1)).unionByName(
        carries.withColumn(IS_ROW, F.lit(0)), allowMissingColumns=True
    )


def previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: Slices, columns: dict[str, str]
) -> DataFrame:
    """Adds, under new names, columns of the row before this one in its key (null on the first)."""
    slices.check(order)
    lagged = lambda w: {new: F.lag(old).over(w) for old, new in columns.items()}

    def sliced(df: DataFrame) -> DataFrame:
        rows = df.withColumn(SLICE, slices.start())
        last = F.max_by(F.struct(*columns), F.struct(*order)).alias("_last")
        by_slice = Window.partitionBy(*keys).orderBy(SLICE)
        carries = (
            rows.groupBy(*keys, SLICE)
            .agg(last)
            .withColumn("_last", F.lag("_last").over(by_slice))
            .where(F.col("_last").isNotNull())
            .select(*keys, SLICE, *[F.col(f"_last.{c}").alias(c) for c in columns if c not in keys])
        )
        here = Window.partitionBy(*keys, SLICE).orderBy(IS_ROW, *order)
        return _put_in_front(rows, carries).withColumns(lagged(here)).where(F.col(IS_ROW) == 1).drop(SLICE, IS_ROW)

    by_key = Window.partitionBy(*keys).orderBy(*order)
    return apart(df, keys, slices, lambda rows: rows.withColumns(lagged(by_key)), sliced)


def islands(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slices: Slices,
    breaks: Callable[[Column, Column], Column],
    values: Sequence[str],
    measures: Sequence[Measure],
) -> DataFrame:
    """Reduces each unbroken run of rows in a key to one row holding its merged measures.

    ``breaks(previous, current)`` tells from the ``values`` of two neighbouring rows, given by name,
    whether a new run begins. Measures may look at the row before too, which is null on a key's
    first row; on the first row of a slice they wait for the slice before. Rows of heavy keys are cut into runs inside their slice first. Only
    the first and the last run of a slice can go on in another slice, so only those are put in
    sequence per key; every other run is already whole and stays spread over the cluster.
    """
    slices.check(order)
    fields = [*order, *[v for v in values if v not in order]]
    merged = [MERGE[m.merge](m.name).alias(m.name) for m in measures]
    current = {v: F.col(v) for v in fields}

    def neighbour(side: str) -> dict[str, Column]:
        return {v: F.col(f"{side}{v}") for v in values}

    def cut(df: DataFrame, group: Sequence[str]) -> DataFrame:
        """Rows with their neighbours' values and the number of their run in the group."""
        w = Window.partitionBy(*group).orderBy(*order)
        beside = {f"_before_{v}": F.lag(v).over(w) for v in values} | {f"_after_{v}": F.lead(v).over(w) for v in values}
        ends = {"_is_first": F.lag(F.lit(1)).over(w).isNull(), "_is_last": F.lead(F.lit(1)).over(w).isNull()}
        opens = F.col("_is_first") | breaks(neighbour("_before_"), current)
        run = F.sum(F.col("_opens").cast("bigint")).over(w.rowsBetween(Window.unboundedPreceding, 0))
        return df.withColumns(beside | ends).withColumn("_opens", opens).withColumn("_run", run)

    def whole(df: DataFrame) -> DataFrame:
        parts = [MERGE[m.merge](m.of(neighbour("_before_"), current)).alias(m.name) for m in measures]
        return cut(df, keys).groupBy(*keys, "_run").agg(*parts).drop("_run")

    def sliced(df: DataFrame) -> DataFrame:
        edge = lambda flag, out: [F.max(F.when(F.col(flag), F.col(f))).alias(f"{out}{f}") for f in fields]
        row = lambda out: F.struct(*[F.col(f"{out}{f}").alias(f) for f in fields])
        closes = F.col("_is_last") | breaks(current, neighbour("_after_"))
        here = lambda m: m.of(neighbour("_before_"), current)
        parts = [MERGE[m.merge](F.when(~F.col("_is_first"), here(m)) if m.looks_back else here(m)).alias(m.name) for m in measures]
        last_run = F.max("_run").over(Window.partitionBy(*keys, SLICE))
        runs = (
            cut(df.withColumn(SLICE, slices.start()), [*keys, SLICE])
            .withColumn("_closes", closes)
            .groupBy(*keys, SLICE, "_run")
            .agg(*edge("_opens", "_first_"), *edge("_closes", "_final_"), *parts)
            .withColumns({"_first": row("_first_"), "_final": row("_final_")})
            .withColumn("_inner", (F.col("_run") > 1) & (F.col("_run") < last_run))
            .withColumns(
                {
                    "_whole_slice": F.when(F.col("_inner"), F.col(SLICE)),
                    "_whole_run": F.when(F.col("_inner"), F.col("_run")),
                }
            )
        )
        group = [*keys, "_whole_slice", "_whole_run"]
        chain = Window.partitionBy(*group).orderBy("_first")
        goes_on = (F.col("_run") == 1) & ~breaks(F.col("_before"), F.col("_first"))
        side = lambda c: {f: F.col(c)[f] for f in fields}
        late = {
            m.name: F.when(F.col("_run") == 1, m.with_first(m.of(side("_before"), side("_first")))).otherwise(F.col(m.name))
            for m in measures
            if m.looks_back
        }
        return (
            runs.withColumn("_before", F.lag("_final").over(chain))
            .withColumns(late)
            .withColumn("_starts", F.when(F.col("_before").isNotNull() & goes_on, 0).otherwise(1))
            .withColumn("_no", F.sum("_starts").over(chain.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*group, "_no")
            .agg(*merged)
            .drop("_whole_slice", "_whole_run", "_no")
        )

    return apart(df, keys, slices, whole, sliced)


def with_halo(
    df: DataFrame, ts: str, width: str | int, before: str | int = 0, after: str | int = 0
) -> DataFrame:
    """Copies rows near a slice edge into the neighbouring slice; ``_own`` marks a row's own slice.

    Each slice then holds all rows up to ``before`` earlier than its first moment and up to
    ``after`` later than its last.
    """
    step, position = micros(width), F.unix_micros(F.col(ts))
    begin = lambda p: p - F.pmod(p, F.lit(step))
    reach = F.sequence(begin(position - micros(after)), begin(position + micros(before)), F.lit(step))
    return df.withColumn(SLICE, F.explode(reach)).withColumn("_own", F.col(SLICE) == begin(position))
