"""Sources and sinks: tables go out to files of each format and are read back by its reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.aggregates import count_by
from tidemark.operators.changes import latest, upsert
from tidemark.session import scratch_dir
from tidemark.sinks import external as sink_external
from tidemark.sinks import files as sink_files
from tidemark.sinks import keyed
from tidemark.sources import external, files
from tidemark.tables import as_change_values, as_log_lines, load, readings
from workload.registry import READINGS, query


@query(
    "source_text_lines",
    """SELECT length(line) AS line_length, count(*) AS n
       FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY ALL""",
)
def source_text_lines(spark, folder):
    lines = load(spark, folder, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    path = scratch_dir(spark, "lines")
    sink_files.write_text(lines, path)
    return count_by(files.text_lines(spark, path), [F.length("value").alias("line_length")])


@query(
    "source_whole_files",
    "SELECT role, count(*) AS n, CAST(sum(turn) AS BIGINT) AS turns FROM conversations GROUP BY role",
)
def source_whole_files(spark, folder):
    turns = load(spark, folder, "conversations").select(F.concat_ws("\t", "role", "turn").alias("value"))
    path = scratch_dir(spark, "whole")
    sink_files.write_text(turns, path, rows_per_file=10_000)
    lines = files.whole_files(spark, path).select(F.explode(F.split(F.rtrim("value", F.lit("\n")), "\n")).alias("line"))
    parts = F.split("line", "\t")
    return lines.groupBy(parts[0].alias("role")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(parts[1].cast("bigint")).alias("turns")
    )


@query(
    "source_json_lines",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type",
)
def source_json_lines(spark, folder):
    path = scratch_dir(spark, "json")
    sink_files.write_json(load(spark, folder, "events").select("event_id", "event_type", "value"), path)
    rows = files.json_lines(spark, path, "event_id bigint, event_type string, value double")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "source_json_inferred",
    "SELECT c_mktsegment AS segment, round(avg(c_acctbal), 4) AS avg_balance FROM customer GROUP BY 1",
)
def source_json_inferred(spark, folder):
    path = scratch_dir(spark, "json")
    sink_files.write_json(load(spark, folder, "customer").select("c_acctbal", "c_mktsegment"), path)
    return files.json_lines(spark, path).groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.round(F.avg("c_acctbal"), 4).alias("avg_balance")
    )


@query(
    "source_delimited_records",
    """SELECT event_type, count(*) AS n, CAST(count(CASE WHEN event_type = 'purchase' THEN 1 END) AS BIGINT) AS n_tx,
              max(epoch_us(ts) // 1000000) AS last_second
       FROM events GROUP BY event_type""",
)
def source_delimited_records(spark, folder):
    """Empty fields come back as null, so "not empty" is "not null"."""
    events = load(spark, folder, "events").select(
        F.col("user_id").alias("order_id"),
        "event_type",
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("tx"), "event_id")).alias("tx_id"),
        F.unix_seconds("ts").alias("time_stamp"),
    )
    path = scratch_dir(spark, "csv")
    sink_files.write_delimited(events, path, ["order_id", "event_type", "tx_id", "time_stamp"])
    rows = files.with_event_time(files.delimited(spark, path, files.SCHEMAS["order"]))
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("tx_id").isNotNull()).alias("n_tx"),
        F.max(F.unix_seconds("ts")).alias("last_second"),
    )


LOG = """(SELECT '10.0.0.' || (user_id % 256) AS ip, CAST(user_id AS VARCHAR) AS user_id,
    epoch_us(ts) // 1000000 AS s, CASE WHEN event_type = 'signup' THEN 'POST' ELSE 'GET' END AS method,
    '/item/' || CAST(json_extract_string(props, '$.k') AS BIGINT) ||
    CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 5
        WHEN 0 THEN '.html' WHEN 1 THEN '.css' WHEN 2 THEN '' WHEN 3 THEN '.css.map' ELSE '.png' END AS url
    FROM events)"""


@query("source_access_log", f"SELECT ip, user_id, s, method, url FROM {LOG}")
def source_access_log(spark, folder):
    log = files.access_log(as_log_lines(load(spark, folder, "events")))
    return log.select("ip", "user_id", F.unix_seconds("ts").alias("s"), "method", "url")


@query(
    "source_declared_tables",
    """SELECT r_name AS area, count(DISTINCT n_name) AS n_cities, count(*) AS n_customers
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def source_declared_tables(spark, folder):
    """Tab-delimited files declared as tables and queried in SQL."""
    nation, region = load(spark, folder, "nation"), load(spark, folder, "region")
    named = nation.join(region, nation.n_regionkey == region.r_regionkey)
    city_path, buyer_path = scratch_dir(spark, "city_info"), scratch_dir(spark, "buyer")
    sink_files.write_delimited(named, city_path, ["n_nationkey", "n_name", "r_name"], "\t")
    sink_files.write_delimited(load(spark, folder, "customer"), buyer_path, ["c_custkey", "c_nationkey"], "\t")
    external.declare_table(spark, "city_info", city_path, files.SCHEMAS["city_info"])
    external.declare_table(spark, "buyer", buyer_path, "buyer_id bigint, city_id bigint")
    return spark.sql(
        """SELECT c.area, count(DISTINCT c.city_name) AS n_cities, count(*) AS n_customers
           FROM buyer b JOIN city_info c ON b.city_id = c.city_id GROUP BY c.area"""
    )


CHANGES = """(SELECT event_id, user_id AS id, 'user' || event_id AS name,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS age,
    CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update' END AS type FROM events)"""


@query("source_change_records", f"SELECT event_id, type, id, name, age FROM {CHANGES}")
def source_change_records(spark, folder):
    values = as_change_values(load(spark, folder, "events"))
    return external.change_records(values, "id bigint, name string, age int").drop("change_ts")


@query(
    "sink_topic_messages",
    """SELECT CAST(o_custkey AS VARCHAR) AS key,
              '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}'
              AS value FROM orders""",
)
def sink_topic_messages(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return sink_external.as_messages(orders, "o_custkey")


@query(
    "sink_documents",
    """SELECT CAST(event_id AS VARCHAR) AS doc_key,
              '{"user_id":"' || user_id || '","event_type":"' || event_type || '"}' AS source FROM events""",
)
def sink_documents(spark, folder):
    path = scratch_dir(spark, "documents")
    sink_files.write_documents(load(spark, folder, "events"), "event_id", ["user_id", "event_type"], path)
    return files.json_lines(spark, path, "doc_key string, source string")


@query(
    "sink_delimited_projection",
    "SELECT user_id AS id, round(value, 2) AS temperature FROM events",
)
def sink_delimited_projection(spark, folder):
    path = scratch_dir(spark, "two_columns")
    sink_files.write_delimited(readings(spark, folder), path, ["id", "temperature"])
    rows = files.delimited(spark, path, "id bigint, temperature double")
    return rows.select("id", F.round("temperature", 2).alias("temperature"))


@query(
    "sink_latest_per_key",
    f"SELECT id, arg_max(temperature, event_id) AS temperature FROM {READINGS} GROUP BY id",
)
def sink_latest_per_key(spark, folder):
    """Last write wins per key, as a hash store would hold it."""
    return latest(readings(spark, folder).select("id", "temperature", "event_id"), ["id"], ["event_id"]).drop("event_id")


@query(
    "sink_upsert",
    f"""SELECT id, coalesce(arg_max(temperature, event_id) FILTER (event_id % 2 = 1), arg_max(temperature, event_id))
        AS temperature FROM {READINGS} GROUP BY id""",
)
def sink_upsert(spark, folder):
    """Two loads merged into a keyed table: known keys updated, new ones inserted, repeats ignored."""
    rows = readings(spark, folder).select("id", "temperature", "event_id")
    path = scratch_dir(spark, "keyed")
    first, second = (rows.where(F.pmod("event_id", F.lit(2)) == half) for half in (0, 1))
    keyed.merge_keyed(first, path, ["id"], ["event_id"], 0)
    keyed.merge_keyed(second, path, ["id"], ["event_id"], 1)
    keyed.merge_keyed(second, path, ["id"], ["event_id"], 1)
    return keyed.read_keyed(spark, path, ["id"], ["event_id"]).drop("event_id")


@query(
    "upsert_merge",
    f"""SELECT id, coalesce(max(CASE WHEN event_id % 2 = 1 THEN event_id END), max(event_id)) AS event_id
        FROM {READINGS} GROUP BY id""",
)
def upsert_merge(spark, folder):
    """An update replaces the current row whatever its age."""
    rows = readings(spark, folder).select("id", "event_id")
    current, updates = (rows.where(F.pmod("event_id", F.lit(2)) == half) for half in (0, 1))
    return upsert(current, updates, ["id"], ["event_id"])
