"""Lots that are tried again, lost and repeated batches, and a ledger that counts each row once."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.session import scratch_dir
from tidemark.sinks.delivery import LotFiles, deliver, lots_of, put_again, read_delivered, read_ledger

SCHEMA = "id bigint, word string"


class Fails:
    """Takes nothing the first ``times`` times."""

    def __init__(self, times):
        self.left, self.took = times, []

    def put(self, name, table):
        self.left -= 1
        if self.left >= 0:
            raise ConnectionError(name)
        self.took.append((name, table.num_rows))


@dataclass(frozen=True)
class Breaks(LotFiles):
    """Never takes the third lot of a delivery."""

    def put(self, name, rows):
        if name.endswith("lot-2"):
            raise ConnectionError(name)
        super().put(name, rows)


@pytest.fixture
def words(spark):
    return spark.range(0, 9000, 1, 3).select("id", F.when(F.col("id") % 7 != 0, F.concat(F.lit("w"), "id")).alias("word"))


def test_lots(spark):
    parts = [pa.record_batch({"n": pa.array(range(n), pa.int64())}) for n in (5, 0, 3, 9, 1)]
    assert [t.num_rows for t in lots_of(iter(parts), 4)] == [4, 4, 4, 4, 2]
    assert pa.concat_tables(lots_of(iter(parts), 4)).equals(pa.Table.from_batches(parts))
    assert list(lots_of(iter(parts[1:2]), 4)) == []


def test_tries_again():
    target, lot = Fails(2), pa.table({"n": [1, 2]})
    put_again(target, "a", lot, 2, 0.0)
    assert target.took == [("a", 2)]
    with pytest.raises(ConnectionError):
        put_again(Fails(3), "a", lot, 2, 0.0)


def test_each_row_once_after_a_lost_and_a_repeated_batch(spark, words):
    path, ledger = scratch_dir(spark, "lots"), scratch_dir(spark, "ledger")
    deliver(words.where("id < 1000"), LotFiles(path), ledger, 0)
    later = words.where("id >= 1000")
    with pytest.raises(Exception, match="lot-2"):
        deliver(later, Breaks(path), ledger, 1, retries=1, pause=0.0)
    seen = read_delivered(spark, path, ledger, SCHEMA)
    assert rows(seen) == rows(words.where("id < 1000"))  # what the lost batch left counts nothing
    assert spark.read.schema(SCHEMA).parquet(path).count() > 1000
    for _ in range(2):  # and once more, in other tasks
        deliver(later, LotFiles(path), ledger, 1)
        later = later.repartition(5)
    assert rows(read_delivered(spark, path, ledger, SCHEMA)) == rows(words)
    lines = read_ledger(spark, ledger)
    assert lines.agg(F.sum("n_rows")).first()[0] == 9000
    assert lines.where("n_rows > 1000 * lots OR n_rows <= 1000 * (lots - 1)").count() == 0


def test_empty_batch_and_repeated_rows(spark):
    path, ledger = scratch_dir(spark, "lots"), scratch_dir(spark, "ledger")
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], SCHEMA)
    deliver(twice, LotFiles(path), ledger, 0, size=2)
    deliver(twice.limit(0), LotFiles(path), ledger, 1)
    assert rows(read_delivered(spark, path, ledger, SCHEMA)) == rows(twice)
