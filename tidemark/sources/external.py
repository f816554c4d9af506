"""Readers of other systems: catalog tables over delimited files, databases, topics, change records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def declare_table(spark: SparkSession, name: str, path: str, schema: str, sep: str = "\t") -> None:
    """Names delimited files as a table for SQL."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {name} ({schema}) USING csv "
        f"OPTIONS (path '{path}', sep '{sep}', mode 'FAILFAST')"
    )


def load_table(spark: SparkSession, name: str, path: str, schema: str, sep: str = "\t") -> None:
    """Loads delimited files into a managed table, replacing what it held."""
    df = spark.read.schema(schema).option("sep", sep).option("mode", "FAILFAST").csv(path)
    df.write.mode("overwrite").saveAsTable(name)


def jdbc_options(url: str, table: str, **more: str) -> dict[str, str]:
    return {"url": url, "dbtable": table} | more


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    split: tuple[str, int, int] | None = None,
    partitions: int = 1,
    **more: str,
) -> DataFrame:
    """A database table; ``split`` (column, lowest, highest) reads it in parallel ranges."""
    options = jdbc_options(url, table, **more)
    if split:
        column, low, high = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**options).load()


def topic_options(servers: str, topics: Sequence[str], **more: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics)} | more


def topic_stream(spark: SparkSession, servers: str, topics: Sequence[str], **more: str) -> DataFrame:
    """Message values of Kafka topics as text. Needs Spark's Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").options(**topic_options(servers, topics, **more)).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def change_records(values: DataFrame, row_schema: str, column: str = "value") -> DataFrame:
    """Change records in the maxwell JSON envelope: kind of change, time, and the row's fields."""
    envelope = f"database string, table string, type string, ts bigint, xid bigint, data struct<{row_schema}>"
    # As a generator's argument the text is parsed once per row, not once per field that is read.
    kept = [c for c in values.columns if c != column]
    parsed = values.select(*kept, F.inline(F.array(F.from_json(column, envelope))))
    return parsed.where(F.col("data").isNotNull()).select(*kept, "type", F.col("ts").alias("change_ts"), "data.*")
