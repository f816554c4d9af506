"""Delivery in lots: small writes that are tried again, and a ledger of what counts.

A task hands its rows to a target in lots, one write each. When all are taken it writes a line to the
batch's ledger, which Spark's committer keeps for one attempt of a task only. What a lost task, a lost
batch or a repeated one left behind has no line there, so reading by the ledger gives each row once.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "task int, delivery string, lots bigint, n_rows bigint"


class Target(Protocol):
    """Takes a lot. Under the same name it may come again, and then replaces what was there."""

    def put(self, name: str, rows: pa.Table) -> None: ...


@dataclass(frozen=True)
class LotFiles:
    """Lots as Parquet files in a folder that all executors reach. A lot is there whole or not at all."""

    path: str

    def put(self, name: str, rows: pa.Table) -> None:
        files, base = pyarrow.fs.FileSystem.from_uri(self.path)
        folder, _, last = name.rpartition("/")
        files.create_dir(f"{base}/{folder}")
        pyarrow.parquet.write_table(rows, f"{base}/{folder}/_{last}", filesystem=files)  # not read under this name
        files.move(f"{base}/{folder}/_{last}", f"{base}/{folder}/{last}.parquet")


def put_again(target: Target, name: str, rows: pa.Table, retries: int, pause: float) -> None:
    """Tries a write and then up to ``retries`` times more, each time after twice the pause."""
    for left in range(retries, -1, -1):
        try:
            return target.put(name, rows)
        except OSError:
            if not left:
                raise
            time.sleep(pause)
            pause *= 2


def lots_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Tables of ``size`` rows, the last one of what is left; holds one lot and one batch."""
    held: list[pa.RecordBatch] = []
    waiting = 0
    for batch in batches:
        while waiting + batch.num_rows >= size:
            yield pa.Table.from_batches([*held, batch.slice(0, size - waiting)])
            batch, held, waiting = batch.slice(size - waiting), [], 0
        if batch.num_rows:
            held.append(batch)
            waiting += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def deliver(
    rows: DataFrame, target: Target, ledger: str, number: int = 0, size: int = 1000, retries: int = 5, pause: float = 0.2
) -> None:
    """Hands all rows to the target, and then writes the ledger of the batch with this number, which replaces an earlier one.

    Lots hold rows of one task, at most ``size``. Nulls and repeated rows are handed on as they are. A batch without
    rows has an empty ledger. A write that fails more than ``retries`` times fails its task, and Spark may start it anew.
    """

    def hand_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, lots, n_rows = TaskContext.get().partitionId(), 0, 0
        delivery = f"delivery={uuid.uuid4().hex}"  # two attempts of a task never write to one name
        for lot in lots_of(batches, size):
            put_again(target, f"{delivery}/lot-{lots}", lot, retries, pause)
            lots, n_rows = lots + 1, n_rows + lot.num_rows
        if lots:
            yield pa.RecordBatch.from_pylist(
                [{"task": task, "delivery": delivery, "lots": lots, "n_rows": n_rows}],
                pa.schema([("task", pa.int32()), ("delivery", pa.string()), ("lots", pa.int64()), ("n_rows", pa.int64())]),
            )

    rows.mapInArrow(hand_over, LEDGER).write.mode("overwrite").parquet(f"{ledger}/batch={number}")


def deliver_each_batch(target: Target, ledger: str, **settings) -> Callable[[DataFrame, int], None]:
    """For writeStream.foreachBatch: delivers every micro-batch."""
    return lambda batch, number: deliver(batch, target, ledger, number, **settings)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One line for each delivery that counts: batch, task, its folder, lots and rows."""
    return spark.read.schema(f"{LEDGER}, batch bigint").parquet(ledger)


def read_delivered(spark: SparkSession, path: str, ledger: str, schema: str) -> DataFrame:
    """The rows in ``LotFiles`` that the ledger knows of, each once."""
    stored = spark.read.schema(f"{schema}, delivery string").parquet(path)
    counted = read_ledger(spark, ledger).select(F.substring_index("delivery", "=", -1).alias("delivery"))
    return stored.join(counted, "delivery", "left_semi").drop("delivery")
