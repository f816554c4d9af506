"""Physical plans stay as designed: pushed filters, pruned columns, early limits, few shuffles."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins, ranking
from tidemark.operators.sequences import Measure, by_time, previous, running
from tidemark.plans import alerts, popularity, traffic
from tidemark.sinks import external as sinks
from tidemark.sources import external
from tidemark.tables import behaviours, cities, load, logins, orders_and_payments, products, readings, sales, side, visits

FOLDER = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def count(text: str, node: str) -> int:
    return len(re.findall(rf"^\(\d+\) {node}", text, re.MULTILINE))


def test_hot_items(spark):
    text = plan(popularity.hot_items(behaviours(spark, FOLDER), "view"))
    assert "EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in text
    assert count(text, "WindowGroupLimit") == 2
    assert count(text, "Exchange") == 3


def test_sequences_shuffle_rows_once(spark):
    """One shuffle of light rows, one of heavy rows, their summaries twice, and key counts per scan."""
    rows = readings(spark, FOLDER)
    one = Measure("n", "sum", F.lit(1).cast("bigint"))
    for df in (
        running(rows, ["id"], ["ts", "event_id"], by_time("ts"), [one]),
        previous(rows, ["id"], ["ts", "event_id"], by_time("ts"), {"temperature": "before"}),
    ):
        text = plan(df)
        assert count(text, "SortMergeJoin") == 0
        scans = count(text, "TakeOrderedAndProject")  # the list of heavy keys is cut before it is broadcast
        assert count(text, "BroadcastHashJoin") == scans == 3
        assert count(text, "Exchange") == scans + 4


@pytest.mark.parametrize(
    "make",
    [
        lambda s: alerts.login_failures(logins(s, FOLDER)),
        lambda s: alerts.payment_timeouts(orders_and_payments(s, FOLDER)),
    ],
)
def test_bounded_patterns_shuffle_once(spark, make):
    text = plan(make(spark))
    assert count(text, "Exchange") == 1
    assert "Join" not in text


def test_no_cross_joins(spark):
    events = load(spark, FOLDER, "events")
    a, b = side(events, "click", "pay"), side(events, "view", "receipt")
    for df in (
        alerts.reconciled_payments(a, b),
        joins.window_join(a, b, ["tx_id"], "pay_ts", "receipt_ts", 5),
        popularity.hot_products_by_region(sales(spark, FOLDER), products(spark, FOLDER), cities(spark, FOLDER)),
        popularity.category_sessions(visits(spark, FOLDER)),
        ranking.top_ranked(readings(spark, FOLDER), ["id"], "temperature", 3),
    ):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_top_list_is_cut_before_it_is_broadcast(spark):
    text = plan(popularity.category_sessions(visits(spark, FOLDER)))
    assert count(text, "TakeOrderedAndProject") == 1 and "LeftSemi" in text


def test_column_pruning_for_visitors(spark):
    text = plan(traffic.unique_visitors(behaviours(spark, FOLDER), "view"))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_external_options():
    options = external.topic_options("a:1,b:2", ["x", "y"], startingOffsets="earliest")
    assert options == {"kafka.bootstrap.servers": "a:1,b:2", "subscribe": "x,y", "startingOffsets": "earliest"}
    assert external.jdbc_options("jdbc:x", "t", user="u") == {"url": "jdbc:x", "dbtable": "t", "user": "u"}


def test_messages(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, v string")
    assert tuple(sinks.as_messages(df, "id").first()) == ("1", '{"id":1,"v":"a"}')
    assert tuple(sinks.as_messages(df).first()) == ('{"id":1,"v":"a"}',)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from types import SimpleNamespace

    from tidemark.session import scratch_dir

    context = SimpleNamespace(
        getConf=lambda: SimpleNamespace(get=lambda _: None), getCheckpointDir=lambda: None, master="yarn"
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(SimpleNamespace(sparkContext=context), "x")
    assert scratch_dir(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_rises_look_back_in_one_pass(spark):
    """Light and heavy rows once each, and the keys' counts for both: no pass of its own for the row before."""
    text = plan(alerts.temperature_rises(readings(spark, FOLDER)))
    assert count(text, "Scan parquet") <= 4
    assert count(text, "SortMergeJoin") == 0
