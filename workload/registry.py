"""Collects the queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


# Roles the tables play, as SQL (the Spark side is tidemark.tables).
BEHAVIOURS = """(SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
    event_type AS behaviour, ts, epoch_us(ts) AS us FROM events)"""
READINGS = "(SELECT user_id AS id, ts, epoch_us(ts) AS us, value AS temperature, event_id FROM events)"
LOGINS = """(SELECT user_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS status,
    epoch_us(ts) // 1000000 AS s, event_id FROM events)"""
SECONDS = 1_000_000
HOUR = 3600 * SECONDS
DAY = 24 * HOUR
