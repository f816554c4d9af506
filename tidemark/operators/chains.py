"""Windows that follow each other: the next one opens at the first row after the last one's end.

Where a window opens depends on where the one before it opened, and so on back to the first: a
sequence that no window function can follow, and that must not become one task's work for a hot
key. But a slice of time only needs to know where the first window in it opens. So each slice is
reduced to a map from that place to where the first window after the slice opens; the maps of a key
are composed by doubling (each step joins a slice's map to that of twice as many slices before);
and then every slice follows its own windows by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sequences import SLICE

# Maps are composed over 2 ** DOUBLINGS slices of a sequence, more than a century of hours; longer ones raise an error.
DOUBLINGS = 20


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value worked out once, also where it is used in a lambda."""
    return F.transform(F.array(value), body)[0]


def chained_windows(
    df: DataFrame, keys: Sequence[str], at: str, within: int, width: int, totals: dict[str, Column]
) -> DataFrame:
    """Windows of ``within`` from the first row of a key on, each opening at the first row after the one before.

    ``at`` is a whole number, once in each key, and no row is more than ``within`` after the one
    before it. One row per window: keys, ``at`` of the row that opens it, and the ``totals``,
    aggregates over the rows up to ``within`` later. What is gathered at one place is a slice, at
    most ``width`` + 2 * ``within`` + 1 rows, whatever a key holds. Null keys are a key.
    """
    reach = max(2 * within, within + 1)
    if width < 2 * reach:
        raise ValueError(f"slices of {width} are too narrow for windows of {within}")
    begin = lambda p: p - F.pmod(p, F.lit(width))
    here = Window.partitionBy(*keys, SLICE).orderBy(at)
    end = F.col(SLICE) + width
    place = F.col(at)
    rows = (
        df.withColumn(SLICE, F.explode(F.sequence(begin(place - reach), begin(place), F.lit(width))))
        .withColumn("_at", F.row_number().over(here) - 1)
        .withColumn("_to", F.min("_at").over(here.rangeBetween(within + 1, reach)))
        .withColumns({name: total.over(here.rangeBetween(0, within)) for name, total in totals.items()})
        .withColumn("_to", F.when(place < end, F.coalesce("_to", "_at")).otherwise(F.col("_at")))
        .groupBy(*keys, SLICE)
        .agg(F.array_sort(F.collect_list(F.struct("_at", at, "_to", *totals))).alias("_rows"))
        .where(F.col("_rows")[0][at] < end)
    )
    entry = _entries(rows, keys, at, reach, width, within)

    def onward(path: Column, _: Column) -> Column:
        return _let(
            F.get("_rows", F.element_at(path, -1))["_to"],
            lambda to: F.when(
                (to == F.element_at(path, -1)) | (F.get("_rows", to)[at] >= end), path
            ).otherwise(F.concat(path, F.array(to))),
        )

    start = (F.array_position(F.col(f"_rows.{at}"), F.col("_entry")) - 1).cast("int")
    path = F.aggregate(F.sequence(F.lit(1), F.lit(width // (within + 1) + 1)), F.array(start), onward)
    renamed = entry.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col(SLICE).alias("_of_slice"), "_entry")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], F.col(SLICE) == F.col("_of_slice"))
    return (
        rows.join(renamed, same)
        .select(*keys, "_rows", F.explode(path).alias("_i"))
        .select(*keys, *[F.get("_rows", F.col("_i"))[c].alias(c) for c in [at, *totals]])
    )


def _entries(rows: DataFrame, keys: Sequence[str], at: str, reach: int, width: int, within: int) -> DataFrame:
    """Where the first window in each slice opens: keys, slice, ``_entry``."""
    end = F.col(SLICE) + width
    jumps = (width // (within + 1) + 1).bit_length()
    far = F.aggregate(
        F.sequence(F.lit(1), F.lit(jumps)),
        F.col("_rows._to"),
        lambda to, _: F.transform(to, lambda j: F.get(to, j)),
    )

    def out(row: Column, far: Column) -> Column:
        place = F.get("_rows", F.get(far, row["_at"]))[at]
        return F.struct(row[at], F.when(place >= end, place))

    may_enter = F.filter("_rows", lambda r: (r["_at"] == 0) | (r[at] < F.col(SLICE) + reach))
    chain = Window.partitionBy(*keys).orderBy(SLICE)
    maps = rows.select(
        *keys,
        SLICE,
        F.col("_rows")[0][at].alias("_first"),
        _let(far, lambda f: F.map_from_entries(F.transform(may_enter, lambda r: out(r, f)))).alias("_map"),
    )
    maps = maps.withColumns({"_first": F.first("_first").over(chain), "_no": F.row_number().over(chain)})
    for k in range(DOUBLINGS):
        both = F.transform_values("_before", lambda _, place: F.try_element_at(F.col("_map"), place))
        maps = (
            maps.withColumn("_before", F.lag("_map", 2**k).over(chain))
            .withColumn("_map", F.when(F.col("_before").isNull(), F.col("_map")).otherwise(both))
            .drop("_before")
        )
    too_long = F.raise_error(F.lit(f"a sequence of more than {2**DOUBLINGS} slices"))
    came = F.lag(F.try_element_at(F.col("_map"), F.col("_first"))).over(chain)
    entry = F.when(F.col("_no") == 1, F.col("_first")).when(F.col("_no") > 2**DOUBLINGS, too_long).otherwise(F.col("_came"))
    return (
        maps.withColumn("_came", came)
        .withColumn("_entry", entry)
        .where(F.col("_entry").isNotNull())
        .select(*keys, SLICE, "_entry")
    )
