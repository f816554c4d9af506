"""Topics and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as topic messages: ``value`` is the row as JSON, ``key`` keeps a key's messages in order."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), value)


def write_topic(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    """Needs Spark's Kafka connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    as_messages(df, key).write.format("kafka").options(**options).save()


# Fixed value: rows per database round trip.
JDBC_BATCH_ROWS = 1000


def jdbc_append(df: DataFrame, url: str, table: str, batch_rows: int = JDBC_BATCH_ROWS, **more: str) -> None:
    """Appends in batches; a failed task is retried by Spark."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows)} | more
    df.write.format("jdbc").options(**options).mode("append").save()
