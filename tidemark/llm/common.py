"""What the operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from tidemark.session import scratch_dir

#: A word, as the contracts of the quality rules and of the mix have it.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a batch that a column function is given at a time.
PART = 1 << 22


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """Writes df once to the shared folder and reads it back: it is not computed again, and its lineage ends here."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def forget(*tables: DataFrame) -> None:
    """Empties tables of kept_table that nothing reads any more, so that long jobs don't fill the shared folder."""
    for df in tables:
        df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(df.kept_at)


def text_of(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def strings(batch: pa.Array) -> Iterator[str]:
    """The texts of an Arrow column, null as empty, one at a time."""
    for text in batch:
        yield text.as_py() or ""


def parts(batch: pa.Array) -> Iterator[pa.Array]:
    """A column in slices of about PART bytes, one row at least."""
    step = max(1, len(batch) * PART // max(batch.nbytes, 1))
    return (batch.slice(at, step) for at in range(0, len(batch), step))


def give_back() -> None:
    """Returns free memory to the system. Workers live on after a task, and others run beside them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def arrow_column(function: Callable[[pa.Array], pa.Array], kind: str) -> Callable[..., Column]:
    """A column function that works on slices of one Arrow batch at a time, in tasks. Memory goes back between batches."""

    def run(batches):
        give_back()
        for batch in batches:
            yield from map(function, parts(batch))
            del batch
            give_back()

    return F.arrow_udf(run, kind, ArrowUDFType.SCALAR_ITER)
