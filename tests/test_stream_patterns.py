"""Streamed patterns and first closings next to plain loops, and their state."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import patterns
from tidemark.streaming import windows as streamed
from tidemark.streaming.processors import PatternMatches, Step, apply_processor, times
from tidemark.streaming.runner import disorder, run_to_table, stream_session, table_stream, with_end

START = datetime(2024, 1, 1)


def replay(spark, tmp_path, rows, schema, apply, **end):
    """Rows in four files that are out of time order, as a stream; the result as a table."""
    df = spark.createDataFrame(rows, schema)
    df.repartition(4, "event_id").write.parquet(str(tmp_path / "events.parquet"))
    stream, last = with_end(table_stream(stream_session(spark), str(tmp_path), "events"), "ts", event_id=-1, **end)
    delay = disorder(spark, str(tmp_path / "events.parquet"), "ts")
    return df, run_to_table(apply(stream.withWatermark("ts", delay)), spark, [last])


def test_a_hot_order_is_split_and_makes_no_pairs(spark, tmp_path):
    draw = random.Random(1)
    rows = []
    for i in range(600):
        key = draw.choice([7, 7, 7, 8, None])
        rows.append((i, key, START + timedelta(seconds=draw.randint(0, 3000)), draw.choice(["create", "create", "pay", "other"])))
    opens, closes = F.col("kind") == "create", F.col("kind") == "pay"
    made = {}

    def apply(stream):
        made["stream"] = streamed.first_closing(stream, "order_id", "ts", opens, closes, "20 seconds", "1 minute")
        return made["stream"]

    df, found = replay(spark, tmp_path, rows, "event_id bigint, order_id bigint, ts timestamp, kind string", apply, order_id=-1, kind="create")
    wanted = patterns.followed_by(df, ["order_id"], "ts", "event_id", opens, closes, "20 seconds")
    columns = ["order_id", "opened_ts", "event_id", "closed_ts"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.select(columns).collect()), key=key) == sorted(map(tuple, wanted.select(columns).collect()), key=key)
    plan = made["stream"]._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan and "slice" in plan  # one order's state lies under one key for each time slice


def plain_matches(events, steps, longest):
    """Every start tries on; a strict step takes the next row or fails, a relaxed one the next row that fits."""
    out = []
    for i, (at, kind) in enumerate(events):
        if kind != steps[0][0]:
            continue
        j, fits = i, True
        for flag, relaxed in steps[1:]:
            j += 1
            while relaxed and j < len(events) and events[j][1] != flag:
                j += 1
            fits = fits and j < len(events) and events[j][1] == flag
            if not fits:
                break
        if fits and events[j][0] - at <= longest:
            out.append((at, events[j][0]))
    return sorted(out)


def test_pattern_automaton(spark, tmp_path):
    draw = random.Random(2)
    rows = [(i, draw.choice([1, 2]), START + timedelta(seconds=draw.randint(0, 2000)), draw.choice("aabc")) for i in range(500)]
    by_key = {k: sorted(((t - START).total_seconds(), i, c) for i, u, t, c in rows if u == k) for k in (1, 2)}
    patterns_ = [
        ((Step("a"), Step("b")), 30),
        ((Step("a"), Step("b", relaxed=True)), 30),
        ((*times("a", 2), Step("c", relaxed=True), Step("b")), 200),
    ]
    for n, (steps, within) in enumerate(patterns_):

        def apply(stream, steps=steps, within=within):
            flags = [(F.col("kind") == c).alias(c) for c in "abc"]
            flagged = stream.select("user_id", "ts", "event_id", *flags)
            return apply_processor(flagged, "user_id", PatternMatches("user_id", "bigint", steps, within * 1_000_000))

        folder = tmp_path / str(n)
        folder.mkdir()
        _, found = replay(spark, folder, rows, "event_id bigint, user_id bigint, ts timestamp, kind string", apply, user_id=-1, kind="a")
        seconds = lambda t: (t - START).total_seconds()
        got = sorted((r["user_id"], seconds(r["first_ts"]), seconds(r["last_ts"])) for r in found.collect())
        plain = [(s.flag, s.relaxed) for s in steps]
        assert got == sorted((k, *m) for k, e in by_key.items() for m in plain_matches([(t, c) for t, _, c in e], plain, within))
        assert got
