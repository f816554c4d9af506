"""Runs a streaming DataFrame over the files at hand and reads its result back as a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.session import ROCKSDB, pin_utc, scratch_dir
from tidemark.sources.streams import file_stream

# Later than any event; closes every window, timer and join interval of a bounded replay.
END_OF_TIME = "2262-01-01 00:00:00"


def stream_session(spark: SparkSession) -> SparkSession:
    """A sibling session with state kept in RocksDB, so the caller's settings stay as they are.

    The state's partition count is fixed for the life of a checkpoint: one per core of the cluster.
    """
    sibling = pin_utc(spark.newSession())
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    sibling.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return sibling


def table_stream(spark: SparkSession, folder: str, name: str, gigabytes_per_batch: int = 16) -> DataFrame:
    """A warehouse table as a stream, so many gigabytes of files at a time, oldest files first.

    Zone-less times become timestamps. Rows of later batches that are behind the watermark are late
    like on any stream: give the watermark the delay that ``disorder`` finds.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    either = f"{folder}/{name}.parque[t]"  # as a pattern it may name a folder of files or one file
    stream = file_stream(spark, either, schema, maxBytesPerTrigger=str(gigabytes_per_batch << 30))
    times = {f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"}
    return stream.withColumns(times) if times else stream


def disorder(spark: SparkSession, path: str, ts: str) -> str:
    """The delay with which no row of these Parquet files is late, in whatever batches they are replayed.

    Files are replayed by age. A file's earliest row may follow the latest row of any file that is
    not younger. One number per file comes to the driver, which lists the files anyway.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    files = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("age"))
        .agg(F.min(at).alias("low"), F.max(at).alias("high"))
        .dropna(subset=["low"])
        .orderBy("age", F.desc("high"))
        .collect()
    )
    behind, highest = 0, None
    for _, same_age in groupby(files, key=lambda f: f["age"]):  # in any order among themselves, highest first here
        group = list(same_age)
        for i, file in enumerate(group):
            rival = group[0]["high"] if i else group[1]["high"] if len(group) > 1 else None
            behind = max([behind, *(high - file["low"] for high in (highest, rival) if high is not None)])
        highest = group[0]["high"] if highest is None else max(highest, group[0]["high"])
    return f"{-(-behind // 1000) + 1} milliseconds"


@dataclass(frozen=True)
class End:
    """The last row of a bounded replay, held back until all other input is processed."""

    row: DataFrame
    path: str

    def release(self) -> None:
        self.row.write.mode("append").parquet(self.path)


def with_end(stream: DataFrame, ts: str, **values) -> tuple[DataFrame, End]:
    """Adds a row at the end of time, so that a bounded replay emits all it holds.

    The row must pass every filter on the way, or the watermark does not move: give its columns by
    name. Its own window never closes, so it is in no windowed result. The row is a second file
    source, empty until the runner has processed everything else and releases it.
    """
    spark = stream.sparkSession
    fields = {f.name: F.lit(END_OF_TIME) if f.name == ts else F.lit(values.get(f.name)) for f in stream.schema}
    row = spark.range(1).select(*[fields[f.name].cast(f.dataType).alias(f.name) for f in stream.schema])
    path = scratch_dir(spark, "end")
    row.limit(0).write.parquet(path)
    return stream.union(file_stream(spark, path, row.schema)), End(row, path)


def run_to_table(
    stream: DataFrame,
    spark: SparkSession,
    ends: Sequence[End] = (),
    mode: str = "append",
    checkpoint: str | None = None,
    out: str | None = None,
) -> DataFrame:
    """Processes all input there is, then stops. Results go to files, not through the driver.

    With a checkpoint they stay next to it, and a later run adds to them.
    """
    out = out or _results(spark, checkpoint)
    start = lambda writer: writer.outputMode(mode).format("parquet").option("path", out)
    _run(stream, spark, start, ends, checkpoint)
    return spark.read.schema(stream.schema).parquet(out)


def run_each_batch(
    stream: DataFrame,
    spark: SparkSession,
    action: Callable[[DataFrame, int], None],
    ends: Sequence[End] = (),
    mode: str = "update",
    checkpoint: str | None = None,
) -> None:
    """Hands every micro-batch to ``action`` as a table with its batch number, then stops."""
    _run(stream, spark, lambda writer: writer.outputMode(mode).foreachBatch(action), ends, checkpoint)


def run_batches_to_table(
    stream: DataFrame,
    spark: SparkSession,
    transform: Callable[[DataFrame], DataFrame],
    ends: Sequence[End] = (),
    checkpoint: str | None = None,
) -> DataFrame:
    """Applies a table operator to each micro-batch of finished rows and collects the results.

    In append mode a finished window comes out with all its keys in one micro-batch, so operators
    per window, such as a ranking, are complete. A repeated batch overwrites its own folder. With a
    checkpoint the results stay next to it, and a later run adds to them.
    """
    out = _results(spark, checkpoint)
    schema = transform(spark.createDataFrame([], stream.schema)).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{out}/batch=none")

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    run_each_batch(stream, spark, write, ends, "append", checkpoint)
    return spark.read.schema(schema).parquet(f"{out}/batch=*")


def _results(spark: SparkSession, checkpoint: str | None) -> str:
    return f"{checkpoint.rstrip('/')}-results" if checkpoint else scratch_dir(spark, "out")


def _run(
    stream: DataFrame,
    spark: SparkSession,
    configure: Callable[[DataStreamWriter], DataStreamWriter],
    ends: Sequence[End],
    checkpoint: str | None,
) -> None:
    checkpoint = checkpoint or scratch_dir(spark, "checkpoint")
    for last in (False, True) if ends else (False,):
        if last:
            for end in ends:
                end.release()
        query = configure(stream.writeStream).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        finally:
            query.stop()
