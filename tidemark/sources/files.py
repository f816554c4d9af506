"""Text, JSON, delimited and access-log readers. Paths may use any file system Spark knows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Positional schemas of the delimited inputs.
SCHEMAS = {
    "sensor": "id string, time_stamp bigint, temperature double",
    "user_behavior": "user_id bigint, item_id bigint, category_id int, behavior string, time_stamp bigint",
    "login": "user_id bigint, ip string, login_status string, time_stamp bigint",
    "order": "order_id bigint, event_type string, tx_id string, time_stamp bigint",
    "receipt": "tx_id string, pay_channel string, time_stamp bigint",
    "user_visit_action": (
        "date string, user_id bigint, session_id string, page_id bigint, action_time string, search_keyword string, "
        "click_category_id bigint, click_product_id bigint, order_category_ids string, order_product_ids string, "
        "pay_category_ids string, pay_product_ids string, city_id bigint"
    ),
    "product_info": "product_id bigint, product_name string, extend_info string",
    "city_info": "city_id bigint, city_name string, area string",
}

# Fixed value: time format of the access log.
LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def text_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per line of a file or folder, however lines end (LF, CRLF or CR).

    ``min_partitions`` asks for at least that many tasks, in a sibling session: it is a setting.
    """
    if min_partitions:
        spark = spark.newSession()
        spark.conf.set("spark.sql.files.minPartitionNum", str(min_partitions))
    return spark.read.text(path)


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its path and full content."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; without a schema Spark reads all data once more to infer one."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ",", corrupt: str | None = None) -> DataFrame:
    """Positional records without header. Empty fields are null.

    A row that does not fit the schema fails the read. With ``corrupt`` it is kept, its text in a
    column of that name. Spark parses only columns that a query reads, so only those can fail.
    """
    reader = spark.read.option("sep", sep)
    if corrupt:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
        schema = f"{schema}, {corrupt} string"
    else:
        reader = reader.option("mode", "FAILFAST")
    return reader.schema(schema).csv(path)


def access_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Web access log lines, space separated: address, user, time, method and URL."""
    parts = F.split(F.col(column), " ")
    return lines.select(
        parts[0].alias("ip"),
        parts[1].alias("user_id"),
        F.to_timestamp(parts[3], LOG_TIME).alias("ts"),
        parts[5].alias("method"),
        parts[6].alias("url"),
    )


def with_event_time(df: DataFrame, column: str = "time_stamp", out: str = "ts") -> DataFrame:
    """Event time from epoch seconds."""
    return df.withColumn(out, F.timestamp_seconds(column))
