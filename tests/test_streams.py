"""Streams over several batches equal their batch twins; restarts go on where they stopped."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.durations import micros
from tidemark.operators.joins import interval_join
from tidemark.operators.lateness import tag_late
from tidemark.operators.sequences import Measure
from tidemark.operators.windows import epoch, sessions, sliding, tumbling
from tidemark.plans import alerts, popularity, traffic
from tidemark.session import scratch_dir
from tidemark.sinks.keyed import grown, merge_each_batch, merge_keyed, read_keyed
from tidemark.sources.streams import file_stream, line_stream
from tidemark.streaming import processors
from tidemark.streaming import windows as streamed
from tidemark.streaming.lateness import late_each_batch, read_rows
from tidemark.streaming.runner import (
    disorder,
    run_batches_to_table,
    run_each_batch,
    run_to_table,
    stream_session,
    with_end,
)
from tidemark.tables import load

EVENTS = "event_id bigint, user_id bigint, kind string, temperature double, ts timestamp"
ONE = lambda: Measure("n", "sum", F.lit(1).cast("bigint"))


@pytest.fixture(scope="module")
def source(spark):
    """Events of three days in time-ordered files, each up to a minute out of order inside."""
    events = load(spark, "/root/testdata/sf0.001", "events").select(
        "event_id", "user_id", F.col("event_type").alias("kind"), F.col("value").alias("temperature"), "ts"
    )
    path = scratch_dir(spark, "events")
    for part in range(4):
        piece = events.where(F.pmod(F.floor(F.col("event_id") / 250), F.lit(4)) == part)
        piece.coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def shuffled(spark, source):
    """The same events in files that are not in time order."""
    events = spark.read.schema(EVENTS).parquet(source)
    path = scratch_dir(spark, "shuffled")
    for part in (2, 0, 3, 1):
        piece = events.where(F.pmod(F.floor(F.col("event_id") / 250), F.lit(4)) == part)
        piece.coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture
def table(spark, source):
    return spark.read.schema(EVENTS).parquet(source)


@pytest.fixture
def stream(spark, source):
    made = file_stream(stream_session(spark), source, EVENTS, files_per_batch=1)
    return with_end(made, "ts", event_id=-1, user_id=-1, kind="view", temperature=0.0)


def same(found, expected):
    assert rows(found.select(*expected.columns)) == rows(expected)


def test_hot_items(spark, stream, table):
    replay, end = stream
    counts = streamed.window_counts(replay.where("kind = 'view'"), "ts", "1 minute", "6 hours", "1 hour", ["user_id"])
    found = run_batches_to_table(counts, spark, streamed.ranked_windows("user_id", 3), [end])
    viewed = table.withColumnsRenamed({"user_id": "item_id", "kind": "behaviour"})
    expected = popularity.hot_items(viewed, "view", "6 hours", "1 hour", 3).withColumnRenamed("item_id", "user_id")
    assert expected.count() > 100
    same(found, expected.select("window_end", "user_id", "n", "rank"))


def test_visitors(spark, stream, table):
    replay, end = stream
    found = run_to_table(streamed.distinct_users(replay.where("kind = 'view'"), "ts", 0, "1 day", "user_id"), spark, [end])
    same(found, traffic.unique_visitors(table.withColumnRenamed("kind", "behaviour"), "view", "1 day").select("window_end", "uv"))


def test_sliding_and_sessions(spark, stream, table):
    replay, end = stream
    marked = replay.withWatermark("ts", "0 seconds")
    found = run_to_table(sliding(marked, "ts", "2 hours", "30 minutes", ["kind"], [ONE()]), spark, [end])
    same(found, sliding(table, "ts", "2 hours", "30 minutes", ["kind"], [ONE()]))


def test_sessions(spark, stream, table):
    replay, end = stream
    found = run_to_table(sessions(replay.withWatermark("ts", "0 seconds"), "ts", "9 hours", ["user_id"], "event_id", [ONE()]), spark, [end])
    columns = ["user_id", "session_start", "session_end", "n"]
    same(found.select(columns), sessions(table, "ts", "9 hours", ["user_id"], "event_id", [ONE()]).select(columns))


@pytest.mark.parametrize(
    "size, slide, delay", [("1 hour", "5 minutes", "1 minute"), ("70 minutes", "20 minutes", "40 days"), ("3 days", "1 day", "1 minute")]
)
def test_sliding_sums_take_off_what_drops_out(spark, stream, table, size, slide, delay):
    """Over several batches, with silences longer than a window and a watermark that moves late or only at the end."""
    replay, end = stream
    sums = streamed.sliding_sums(
        replay.withWatermark("ts", delay), "ts", size, slide, ["kind"], {"n": F.lit(1), "of_users": F.col("user_id")}
    )
    measures = [ONE(), Measure("of_users", "sum", F.col("user_id").cast("bigint"))]
    same(run_to_table(sums, spark, [end]), sliding(table, "ts", size, slide, ["kind"], measures))


def test_sliding_sums_of_null_keys_and_values(spark):
    path = scratch_dir(spark, "nulls")
    made = [(None, 5, 0), (None, None, 100), (0, 7, 50), (0, -7, 59), (3, 2**40, 4000), (None, 1, 90000)]
    schema = "k int, v bigint, ts timestamp"
    spark.createDataFrame(made, "k int, v bigint, s bigint").selectExpr("k", "v", "timestamp_seconds(s) AS ts").coalesce(
        1
    ).write.parquet(path)
    replay, end = with_end(file_stream(stream_session(spark), path, schema), "ts")
    sums = {"n": F.lit(1), "v": F.col("v")}
    marked = replay.withWatermark("ts", "0 seconds")
    found = run_to_table(streamed.sliding_sums(marked, "ts", "2 minutes", "1 minute", ["k"], sums), spark, [end])
    wanted = {}
    for k, v, s in made:
        for w in range(s // 60 * 60 + 60, s // 60 * 60 + 121, 60):
            n, total = wanted.get((k, w), (0, 0))
            wanted[k, w] = n + 1, total + (v or 0)
    assert rows(found.select("k", F.unix_seconds("window_end"), "n", "v")) == sorted(((*key, *value) for key, value in wanted.items()), key=repr)
    with pytest.raises(ValueError, match="whole numbers"):
        streamed.sliding_sums(marked, "ts", "2 minutes", "1 minute", ["k"], {"v": F.lit(0.5)})


def test_changes_take_back_what_they_told(spark, source, table):
    """Each batch tells a changed key's old total once as -1 and its new one as +1; a null key is a key."""
    made = file_stream(stream_session(spark), source, EVENTS, files_per_batch=1)
    key = F.when(F.col("user_id") % 5 != 0, F.col("user_id"))
    measures = {"n": F.lit(1), "v": F.when(F.col("kind") == "view", F.lit(1))}
    changes = run_to_table(streamed.retractions(made.withColumn("user_id", key), ["user_id"], measures), spark)
    expected = table.groupBy(key.alias("user_id")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == "view").alias("v"))
    same(streamed.replayed_changes(changes), expected)
    taken, told = (changes.where(F.col("change") == c).drop("change") for c in (-1, 1))
    assert taken.count() > expected.count()  # every key over several batches
    assert taken.exceptAll(told).count() == 0
    assert told.exceptAll(taken).count() == expected.count()


def test_changes_of_nothing(spark):
    path = scratch_dir(spark, "none")
    spark.range(0).write.parquet(path)
    made = file_stream(stream_session(spark), path, "id bigint")
    assert run_to_table(streamed.retractions(made, ["id"], {"n": F.lit(1)}), spark).count() == 0


def test_second_stage(spark, stream, table):
    replay, end = stream
    salted = replay.where("kind = 'view'").withColumn("salt", F.pmod("event_id", F.lit(3)))
    counts = streamed.window_counts(salted, "ts", 0, "1 hour", None, ["salt"])
    total = counts.groupBy("window").agg(F.sum("n").alias("n")).select(F.col("window.end").alias("window_end"), "n")
    same(run_to_table(total, spark, [end]), traffic.page_views(table.withColumnRenamed("kind", "behaviour"), "view"))


def test_interval_join(spark, source, table):
    def half(df, kind, prefix):
        named = {"user_id": "tx_id", "event_id": f"{prefix}_id", "ts": f"{prefix}_ts"}
        return df.where(F.col("kind") == kind).withColumnsRenamed(named).select(*named.values())

    session = stream_session(spark)
    parts = []
    for key, kind in enumerate(("click", "view"), 1):
        made = file_stream(session, source, EVENTS, files_per_batch=1)
        parts.append(with_end(made, "ts", event_id=-1, user_id=-key, kind=kind, temperature=0.0))
    pays = half(parts[0][0], "click", "pay").withWatermark("pay_ts", "0 seconds")
    receipts = half(parts[1][0], "view", "receipt").withWatermark("receipt_ts", "0 seconds")
    ends = [end for _, end in parts]
    expected = alerts.matched_payments(half(table, "click", "pay"), half(table, "view", "receipt"), "3 hours", "9 hours")
    found = run_to_table(interval_join(pays, receipts, ["tx_id"], "pay_ts", "receipt_ts", "-3 hours", "9 hours"), spark, ends)
    assert expected.count() > 20
    same(found, expected)


@pytest.mark.parametrize("join", ["interval", "reconciled"])
def test_hot_key_waits_in_many_partitions(spark, source, join):
    """All rows of one key: the state of both sides is cut by time. Without an end, so state is still there."""
    session = stream_session(spark)
    checkpoint = scratch_dir(spark, "hot")
    halves = [
        file_stream(session, source, EVENTS)
        .where(F.col("kind") == kind)
        .select(F.lit(1).alias("tx_id"), F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))
        .withWatermark(f"{prefix}_ts", "40 days")
        for kind, prefix in (("click", "pay"), ("view", "receipt"))
    ]
    if join == "interval":
        found = interval_join(*halves, ["tx_id"], "pay_ts", "receipt_ts", "-1 hours", "2 hours")
    else:
        found = streamed.reconciled(*halves, "tx_id", "pay_ts", "receipt_ts", "-1 hours", "2 hours")
    pairs = run_to_table(found, spark, checkpoint=checkpoint)
    table = spark.read.schema(EVENTS).parquet(source)
    named = lambda kind, prefix: table.where(F.col("kind") == kind).select(
        F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts")
    )
    near = F.expr("receipt_ts BETWEEN pay_ts - INTERVAL 1 HOUR AND pay_ts + INTERVAL 2 HOURS")
    expected = named("click", "pay").join(named("view", "receipt"), near).select("pay_id", "receipt_id")
    assert expected.count() > 100
    same(pairs, expected)
    for operator in {"interval": (0,), "reconciled": (0, 1)}[join]:
        for side in ("left", "right"):
            state = spark.read.format("statestore").option("operatorId", operator).option("joinSide", side).load(checkpoint)
            shares = [r["count"] for r in state.groupBy("partition_id").count().collect()]
            assert len(shares) >= 6 and max(shares) < 0.5 * sum(shares)


def processed(name, table):
    """A processor, the key it runs by, and what it must find."""
    readings = table.withColumnRenamed("user_id", "id")
    if name == "count":
        return processors.RunningCount(), "id", alerts.reading_numbers(readings).select("id", "event_id", "nth")
    if name == "jumps":
        return processors.Jumps(20.0), "id", alerts.temperature_jumps(readings, 20.0).select("id", "before", "after")
    if name == "averages":
        expected = alerts.rolling_averages(readings, 10, 2).withColumn("avg_temp", F.round("avg_temp", 6))
        return processors.CountedAverage(10, 2), "id", expected
    if name == "rising":
        expected = alerts.temperature_rises(readings, "12 hours").select("id", "run_start")
        return processors.RisingAlert(12 * 3600 * 1_000_000), "id", expected
    if name == "silence":
        table.createOrReplaceTempView("silence_input")
        expected = table.sparkSession.sql(
            """SELECT user_id AS id, s AS last_second FROM (SELECT user_id, unix_seconds(ts) AS s,
                 lead(unix_seconds(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS later FROM silence_input)
               WHERE later IS NULL OR later - s > 86400"""
        )
        return processors.SilenceTimer(86400), "id", expected
    return processors.FailBursts(86400), "user_id", alerts.login_bursts(logins_of(table), 86400)


def logins_of(df):
    status = F.when(F.col("kind") == "error", "fail").otherwise("success").alias("status")
    return df.select("user_id", "event_id", F.date_trunc("second", "ts").alias("ts"), status)


@pytest.mark.parametrize(
    ("files", "name"),
    [("source", "count"), *(("shuffled", n) for n in ("count", "jumps", "averages", "rising", "silence", "bursts"))],
)
def test_processors(spark, request, table, name, files):
    """One file a batch, in time order or not: every row counts, in its place."""
    path = request.getfixturevalue(files)
    processor, key, expected = processed(name, table)
    made = file_stream(stream_session(spark), path, EVENTS, files_per_batch=1)
    replay, end = with_end(made, "ts", event_id=-1, user_id=-1, kind="error", temperature=0.0)
    replay = logins_of(replay) if name == "bursts" else replay.withColumnRenamed("user_id", "id")
    found = run_to_table(processors.apply_processor(replay.withWatermark("ts", disorder(spark, path, "ts")), key, processor), spark, [end])
    if name == "averages":
        found = found.withColumn("avg_temp", F.round("avg_temp", 6))
    assert expected.count() > 0
    same(found, expected)


def test_disorder(spark, source, shuffled, tmp_path):
    hours = lambda path: micros(disorder(spark, path, "ts")) / 3.6e9
    assert hours(shuffled) > 24 > hours(source)
    one = str(tmp_path / "one")
    spark.range(9).select(F.timestamp_seconds("id").alias("ts")).coalesce(1).write.parquet(one)
    assert disorder(spark, one, "ts") == "1 milliseconds"


def test_counts_of_shuffled_files(spark, shuffled, table):
    made = file_stream(stream_session(spark), shuffled, EVENTS, files_per_batch=1)
    replay, end = with_end(made, "ts", event_id=-1, user_id=-1, kind="view", temperature=0.0)
    counts = streamed.window_counts(replay, "ts", disorder(spark, shuffled, "ts"), "1 hour", None, [])
    found = run_to_table(counts.select("n"), spark, [end])
    assert found.agg(F.sum("n")).first()[0] == table.count()


def test_results_stay_over_restarts(spark, source, tmp_path):
    """A run without new files, and one with some, give all rows so far."""
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

    def run():
        made = file_stream(stream_session(spark), path, "n bigint")
        return [
            run_to_table(made, spark, checkpoint=checkpoint + "-a").count(),
            run_batches_to_table(made, spark, lambda df: df, checkpoint=checkpoint + "-b").count(),
        ]

    spark.range(10).withColumnRenamed("id", "n").write.parquet(path)
    assert run() == [10, 10]
    assert run() == [10, 10]
    spark.range(5).withColumnRenamed("id", "n").write.mode("append").parquet(path)
    assert run() == [15, 15]


def test_restart_keeps_totals(spark, tmp_path):
    """Lines counted before a stop are still counted after it, and none twice."""
    lines, checkpoint, totals = tmp_path / "in", str(tmp_path / "checkpoint"), str(tmp_path / "totals")
    lines.mkdir()

    def run():
        counts = line_stream(stream_session(spark), str(lines)).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        run_each_batch(counts, spark, merge_each_batch(totals, ["value"], ["n"]), checkpoint=checkpoint)
        return rows(read_keyed(spark, totals, ["value"], ["n"]))

    (lines / "1.txt").write_text("a\nb\na\n")
    assert run() == [("a", 2), ("b", 1)]
    assert run() == [("a", 2), ("b", 1)]
    (lines / "2.txt").write_text("a\nc\n")
    assert run() == [("a", 3), ("b", 1), ("c", 1)]


def test_keyed_merges_and_levels(spark, tmp_path):
    path = str(tmp_path / "keyed")
    assert read_keyed(spark, path, ["k"], ["at"], schema="k bigint, v bigint, at bigint").count() == 0
    expected = {}
    for step in range(12):
        made = [(k, step * 10 + k, step) for k in range(step % 3, 6, 2)]
        expected |= {k: v for k, v, _ in made}
        updates = spark.createDataFrame(made, "k bigint, v bigint, at bigint")
        for _ in range(2):  # a repeated batch changes nothing
            merge_keyed(updates, path, ["k"], ["at"], step, fan=3)
    assert {r["k"]: r["v"] for r in read_keyed(spark, path, ["k"], ["at"]).collect()} == expected
    steps = [tuple(map(int, p.name.split("-")[1:])) for p in (tmp_path / "keyed").iterdir()]
    assert any(first < last for first, last in steps) and len(steps) < 12


def test_small_merges_never_rewrite_the_table(spark, tmp_path):
    """Counted: all rows that 20 merges of one key write, next to a table of 100 000."""
    path = tmp_path / "keyed"
    base = spark.range(100_000).selectExpr("id AS k", "hash(id) AS v", "0L AS at")
    merge_keyed(base, str(path), ["k"], ["at"], 0, fan=4)
    written = 0
    for step in range(1, 21):
        before = set(path.iterdir())
        merge_keyed(base.where(f"k = {step % 5}").withColumn("v", F.lit(step)), str(path), ["k"], ["at"], step, fan=4)
        (new,) = [p for p in path.iterdir() if p not in before]
        written += spark.read.parquet(str(new)).count()
    assert written < 100 and (path / "run-0-0").exists()
    found = read_keyed(spark, str(path), ["k"], ["at"])
    assert found.count() == 100_000
    assert {r["k"]: r["v"] for r in found.where("k < 5").collect()} == {0: 20, 1: 16, 2: 17, 3: 18, 4: 19}


def test_a_merge_that_failed_is_written_again(spark, tmp_path):
    """A run without its marker is not read, and the repeated batch replaces it."""
    path = tmp_path / "keyed"
    updates = lambda v: spark.createDataFrame([(1, v, v)], "k bigint, v bigint, at bigint")
    merge_keyed(updates(1), str(path), ["k"], ["at"], 0)
    merge_keyed(updates(2), str(path), ["k"], ["at"], 1)
    (path / "run-1-1" / "_SUCCESS").unlink()
    assert rows(read_keyed(spark, str(path), ["k"], ["at"]), "k", "v") == [(1, 1)]
    merge_keyed(updates(3), str(path), ["k"], ["at"], 1)
    assert rows(read_keyed(spark, str(path), ["k"], ["at"]), "k", "v") == [(1, 3)]


@pytest.mark.parametrize("fan", [2, 8])
def test_levels_are_few_and_rewrites_rare(fan):
    """A thousand equal steps on a large table: runs kept, and bytes rewritten for each byte that came."""
    sizes, written, most = [1_000_000], 0, 0
    for _ in range(1000):
        n = grown(sizes, fan)
        sizes[len(sizes) - n :] = [sum(sizes[len(sizes) - n :]) + 1]
        written, most = written + sizes[-1], max(most, len(sizes))
    assert sizes[0] == 1_000_000 and sum(sizes) == 1_001_000
    levels = math.ceil(math.log(1000, fan)) + 1
    assert most <= fan * levels and written <= 1000 * levels


def test_late_updates_do_not_undo_newer_ones(spark, tmp_path):
    path = str(tmp_path / "images")
    for step, made in enumerate([[(1, "new", 9)], [(1, "old", 3), (2, "x", 4)]]):
        merge_keyed(spark.createDataFrame(made, "k bigint, v string, at bigint"), path, ["k"], ["at"], step, by_arrival=False)
    assert rows(read_keyed(spark, path, ["k"], ["at"], by_arrival=False), "k", "v") == [(1, "new"), (2, "x")]


def test_refreshed_counts_accept_late_rows(spark, tmp_path):
    """Rows inside the allowed lateness refine a window already shown; later ones are dropped."""
    source = tmp_path / "in"
    totals = str(tmp_path / "totals")
    batches = [[1, 14], [16, 40], [2], [700], [3]]
    for i, seconds in enumerate(batches):
        df = spark.createDataFrame([(s,) for s in seconds], "s bigint").select(F.timestamp_seconds("s").alias("ts"))
        df.coalesce(1).write.mode("append").parquet(str(source))
        made = file_stream(stream_session(spark), str(source), "ts timestamp")
        counts = streamed.window_counts(made, "ts", 62, 15, None, []).select(epoch(F.col("window.end")).alias("end"), "n")
        run_each_batch(counts, spark, merge_each_batch(totals, ["end"], ["n"]), checkpoint=str(tmp_path / "checkpoint"))
        shown = dict(rows(read_keyed(spark, totals, ["end"], ["n"])))
        assert shown[15] == (2 if i < 2 else 3)
    assert shown == {15: 3, 30: 1, 45: 1, 705: 1}


def test_tumbling_minimum_row(spark, stream, table):
    replay, end = stream
    coldest = lambda: F.min_by(F.struct("temperature", "event_id"), F.struct("temperature", "event_id")).alias("row")
    found = run_to_table(tumbling(replay.withWatermark("ts", "62 seconds"), "ts", "1 day", ["kind"], [coldest()]), spark, [end])
    same(found.select("kind", "window_end", "row.event_id"), tumbling(table, "ts", "1 day", ["kind"], [coldest()]).select("kind", "window_end", "row.event_id"))


def test_late_rows_over_batches(spark, tmp_path):
    """Rows arriving over several batches are judged as if they had arrived in one."""
    draw = random.Random(3)
    made = [(i, 1_000_000 + 7 * i - draw.choice([0, 0, 0, 60, 300, 900])) for i in range(600)]
    source, path = tmp_path / "in", str(tmp_path / "out")
    lateness = {"arrival": "n", "size": 15, "slide": 15, "disorder": 2, "lateness": 60, "arrivals_per_slice": 20}
    for part in range(3):
        df = spark.createDataFrame(made[part * 200 : part * 200 + 200], "n bigint, s bigint")
        df.withColumn("ts", F.timestamp_seconds("s")).coalesce(1).write.mode("append").parquet(str(source))
    stream = file_stream(stream_session(spark), str(source), "n bigint, s bigint, ts timestamp", files_per_batch=1)
    run_each_batch(stream, spark, late_each_batch(path, "ts", **lateness), mode="append")
    table = spark.read.parquet(str(source))
    expected = tag_late(table, ts="ts", **lateness).select("n", "is_late")
    assert expected.where("is_late").count() > 50
    same(read_rows(spark, path), expected)
