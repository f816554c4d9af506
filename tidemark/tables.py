"""Readers for the warehouse tables, and the roles they play in the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import pin_utc


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table; zone-less times become timestamps so that watermarks accept them."""
    pin_utc(spark)
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    times = {f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
    return df.withColumns(times) if times else df


def behaviours(spark: SparkSession, folder: str) -> DataFrame:
    """User behaviour: who did what to which item, and when."""
    return as_behaviours(load(spark, folder, "events"))


def as_behaviours(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.col("event_type").alias("behaviour"),
        "ts",
    )


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Sensor readings: one sensor per user, the event value as its temperature."""
    return as_readings(load(spark, folder, "events"))


def as_readings(events: DataFrame) -> DataFrame:
    return events.select(F.col("user_id").alias("id"), "ts", F.col("value").alias("temperature"), "event_id")


def logins(spark: SparkSession, folder: str) -> DataFrame:
    """Login attempts in whole seconds: an error is a failed one, all else succeeded."""
    return as_logins(load(spark, folder, "events"))


def as_logins(events: DataFrame) -> DataFrame:
    return events.select(
        "user_id",
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("status"),
        F.date_trunc("second", "ts").alias("ts"),
        "event_id",
    )


def orders_and_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Order life cycle: a sign-up opens the order, a purchase pays it."""
    return as_orders_and_payments(load(spark, folder, "events"))


def as_orders_and_payments(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin("signup", "purchase")).select(
        F.col("user_id").alias("order_id"),
        F.when(F.col("event_type") == "signup", "create").otherwise("pay").alias("event_type"),
        "ts",
        "event_id",
    )


def visits(spark: SparkSession, folder: str) -> DataFrame:
    return as_visits(load(spark, folder, "events"))


def side(events: DataFrame, event_type: str, prefix: str) -> DataFrame:
    """One event type as one side of a two-stream join."""
    return events.where(F.col("event_type") == event_type).select(
        F.col("user_id").alias("tx_id"),
        F.col("event_id").alias(f"{prefix}_id"),
        F.col("ts").alias(f"{prefix}_ts"),
    )


def as_visits(events: DataFrame) -> DataFrame:
    """Visits with at most one of: a clicked category, ordered categories, paid categories.

    As in the visit log "-1" and "null" stand for none, and lists are comma separated.
    """
    kind, item = F.col("event_type"), F.col("item")
    two = lambda second: F.concat_ws(",", item.cast("string"), second.cast("string"))
    return events.withColumn("item", F.get_json_object("props", "$.k").cast("bigint")).select(
        "event_id",
        F.col("user_id").alias("session_id"),
        F.when(kind == "click", item.cast("string")).otherwise("-1").alias("click_category_id"),
        F.when(kind == "signup", two((item + 1) % 100)).otherwise("null").alias("order_category_ids"),
        F.when(kind == "purchase", two(F.col("user_id") % 100)).otherwise("null").alias("pay_category_ids"),
    )


def as_log_lines(events: DataFrame) -> DataFrame:
    """Events as lines of a web access log."""
    item = F.get_json_object("props", "$.k").cast("bigint")
    ending = F.element_at(F.array(*[F.lit(e) for e in (".html", ".css", "", ".css.map", ".png")]), (item % 5 + 1).cast("int"))
    return events.select(
        F.concat_ws(
            " ",
            F.concat(F.lit("10.0.0."), F.col("user_id") % 256),
            F.col("user_id").cast("string"),
            F.lit("-"),
            F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
            F.lit("+0000"),
            F.when(F.col("event_type") == "signup", "POST").otherwise("GET"),
            F.concat(F.lit("/item/"), item.cast("string"), ending),
        ).alias("value")
    )


def as_actions(events: DataFrame) -> DataFrame:
    """Marketing actions: the event type as behaviour, one of three channels per user."""
    channel = F.element_at(F.array(F.lit("app store"), F.lit("wechat"), F.lit("weibo")), (F.col("user_id") % 3 + 1).cast("int"))
    return events.select(channel.alias("channel"), F.col("event_type").alias("behaviour"), "ts", "event_id")


def as_change_values(events: DataFrame) -> DataFrame:
    """Events as change records of a user table, in the maxwell JSON envelope; errors delete."""
    kind = F.when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "signup", "insert").otherwise("update")
    row = F.struct(
        F.col("user_id").alias("id"),
        F.concat(F.lit("user"), F.col("event_id").cast("string")).alias("name"),
        F.get_json_object("props", "$.k").cast("int").alias("age"),
    )
    envelope = F.struct(
        F.lit("shop").alias("database"),
        F.lit("users").alias("table"),
        kind.alias("type"),
        F.unix_seconds("ts").alias("ts"),
        F.col("event_id").alias("xid"),
        row.alias("data"),
    )
    return events.select("event_id", F.to_json(envelope).alias("value"))


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """One row per sold line item: product and the buyer's city (nation)."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    buyers = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    placed = orders.join(buyers, orders.o_custkey == buyers.c_custkey).select("o_orderkey", "c_nationkey")
    return lines.join(placed, lines.l_orderkey == placed.o_orderkey).select(
        F.col("l_partkey").alias("product_id"), F.col("c_nationkey").alias("city_id")
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))


def cities(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = load(spark, folder, "nation"), load(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city_name"), F.col("r_name").alias("area")
    )


def as_arrivals(events: DataFrame) -> DataFrame:
    """Events in an order of arrival that is up to 50 places off their order in time."""
    arrival = F.col("event_id") + F.pmod(F.col("event_id") * 7919, F.lit(50))
    return events.select("event_id", arrival.alias("arrival"), "ts")
