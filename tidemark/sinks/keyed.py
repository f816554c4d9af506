"""Keyed tables kept up to date by upserts, without a database.

A keyed table is a folder of runs. A merge writes one run that holds only its updates, one row per
key, so it costs what the updates cost and not what the table costs. Reading takes all runs and keeps
the last row of each key. Runs are kept in levels: when the newest runs have grown to FAN, they and
the next merge become one run, together with each older run that is not larger than all that is newer
than it. So a large run is rewritten only once as much again has come. With equal steps a level holds
up to FAN runs, each FAN times as large as those of the level below, and a row is rewritten once a level.

A run is named by the first and last step it holds. Spark moves its files into place when its job
commits, and it counts once its _SUCCESS marker is there, so a lost job or a repeated batch leaves
nothing half written. A run that a larger one holds too is removed a rewrite later: readers that
began earlier still find theirs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changes import latest

FAN = 8


@dataclass(frozen=True)
class Run:
    """Merged steps ``first`` to ``last`` and the bytes they take."""

    first: int
    last: int
    size: int

    @property
    def name(self) -> str:
        return f"run-{self.first}-{self.last}"

    def holds(self, other: Run) -> bool:
        return self != other and self.first <= other.first and other.last <= self.last


def _finished(spark: SparkSession, path: str) -> list[Run]:
    """All finished runs that are still there."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        kind, *steps = status.getPath().getName().split("-")
        if kind == "run" and files.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            first, last = map(int, steps)
            found.append(Run(first, last, files.getContentSummary(status.getPath()).getLength()))
    return found


def _remove(spark: SparkSession, path: str, runs: list[Run]) -> None:
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for run in runs:
        files.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{run.name}"), True)


def _live(found: list[Run]) -> list[Run]:
    """The runs that no other run holds, oldest first: each step is in exactly one of them."""
    return sorted((r for r in found if not any(o.holds(r) for o in found)), key=lambda r: r.first)


def grown(sizes: Sequence[int], fan: int) -> int:
    """How many of the newest runs, given oldest first, the next merge takes in."""
    newer = taken = 0
    for size in reversed(sizes):
        if taken and size > newer:
            break
        newer, taken = newer + size, taken + 1
    return taken if taken >= fan else 0


def _rows(spark: SparkSession, path: str, runs: list[Run]) -> DataFrame:
    parts = [spark.read.parquet(f"{path}/{r.name}").withColumn("_step", F.lit(r.last)) for r in runs]
    return reduce(DataFrame.unionByName, parts)


def _resolved(rows: DataFrame, keys: Sequence[str], order: Sequence[str], by_arrival: bool) -> DataFrame:
    return latest(rows, keys, ["_step", *order] if by_arrival else order).drop("_step")


def read_keyed(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], by_arrival: bool = True, schema: str | None = None
) -> DataFrame:
    """The table as the merges so far left it. Before the first merge it is empty, and its schema must be given."""
    runs = _live(_finished(spark, path))
    if not runs:
        if schema is None:
            raise ValueError(f"nothing was merged into {path} yet, and no schema is given")
        return spark.createDataFrame([], schema)
    return _resolved(_rows(spark, path, runs), keys, order, by_arrival)


def merge_keyed(
    updates: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    step: int | None = None,
    by_arrival: bool = True,
    fan: int = FAN,
) -> None:
    """Replaces rows whose key is in the updates and adds the rest.

    Among updates the highest in ``order`` counts. Against rows already there an update always wins,
    or only if it is higher, when ``by_arrival`` is False. A step number (a stream's batch number)
    makes the merge repeatable: a step that is done is not applied again.
    """
    spark = updates.sparkSession
    found = _finished(spark, path)
    runs = _live(found)
    newest = runs[-1].last if runs else -1
    step = newest + 1 if step is None else step
    if step <= newest:
        return
    taken = runs[len(runs) - grown([r.size for r in runs], fan) :]
    if not taken:
        latest(updates, keys, order).write.mode("overwrite").parquet(f"{path}/{Run(step, step, 0).name}")
        return
    rows = _rows(spark, path, taken).unionByName(updates.withColumn("_step", F.lit(step)))
    whole = Run(taken[0].first, step, 0)
    _resolved(rows, keys, order, by_arrival).write.mode("overwrite").parquet(f"{path}/{whole.name}")
    _remove(spark, path, [r for r in found if r not in runs])


def merge_each_batch(
    path: str, keys: Sequence[str], order: Sequence[str], by_arrival: bool = True
) -> Callable[[DataFrame, int], None]:
    """For writeStream.foreachBatch: merges every micro-batch into the keyed table."""
    return lambda batch, number: merge_keyed(batch, path, keys, order, number, by_arrival)
