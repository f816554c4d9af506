"""Sliced operators against plain window functions, with one key holding a third of all rows.

Results must not depend on slice width, input order or partitioning.
"""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.durations import micros
from tidemark.operators import aggregates, joins, lateness, patterns, ranking, windows
from tidemark.operators.chains import chained_windows
from tidemark.operators.sequences import Measure, by_number, by_time, previous, running
from tidemark.plans import popularity, traffic

N = 3000
SPAN = 5 * 3600
ORDER = ["ts", "event_id"]


def same(found, expected):
    found = found.select(expected.columns)
    assert found.count() == expected.count()
    assert found.exceptAll(expected).count() == 0


@pytest.fixture(scope="module")
def events(spark):
    """Whole seconds, so many rows share a time; null keys; one hot key; shuffled input order."""
    draw = random.Random(5)
    made = []
    for i in range(N):
        key = 1 if draw.random() < 0.34 else draw.choice([None, 2, 3, 4, 5, 6, 7, 8, 9])
        status = draw.choice(["fail", "fail", "success"])
        made.append((i, key, draw.randrange(SPAN), status, draw.randrange(40) / 2))
    draw.shuffle(made)
    df = spark.createDataFrame(made, "event_id bigint, id bigint, s bigint, status string, temperature double")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s").repartition(7).cache()


def ordered(frame=True):
    w = Window.partitionBy("id").orderBy(*ORDER)
    return w.rowsBetween(Window.unboundedPreceding, 0) if frame else w


WIDTHS = ["7 seconds", "10 minutes", "1 day"]
# All keys cut, only the hot one, none.
HEAVY = [1, 600, 10_000]
ONE = F.lit


def ones(name="n"):
    return Measure(name, "sum", F.lit(1).cast("bigint"))


@pytest.mark.parametrize("heavy", HEAVY)
@pytest.mark.parametrize("width", WIDTHS)
def test_running(events, width, heavy):
    found = running(events, ["id"], ORDER, by_time("ts", width, heavy), [ones(), Measure("hi", "max", F.col("temperature"))])
    expected = events.withColumn("n", F.count(F.lit(1)).over(ordered())).withColumn("hi", F.max("temperature").over(ordered()))
    same(found, expected)


@pytest.mark.parametrize("width", [1, 50, 10_000])
def test_running_without_keys(events, width):
    found = running(events, [], ["event_id"], by_number("event_id", width), [ones(), Measure("lo", "min", F.col("temperature"))], exclusive=True)
    before = Window.orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    expected = events.withColumn("n", F.sum(F.lit(1).cast("bigint")).over(before)).withColumn("lo", F.min("temperature").over(before))
    same(found, expected)


@pytest.mark.parametrize("heavy", HEAVY)
@pytest.mark.parametrize("width", WIDTHS)
def test_previous(events, width, heavy):
    found = previous(events, ["id"], ORDER, by_time("ts", width, heavy), {"temperature": "before", "ts": "before_ts"})
    lagged = {new: F.lag(old).over(ordered(False)) for old, new in (("temperature", "before"), ("ts", "before_ts"))}
    same(found, events.withColumns(lagged))


@pytest.mark.parametrize("width", WIDTHS)
def test_running_max_row(events, width):
    slim = events.select("id", "event_id", "temperature", "ts")
    found = aggregates.running_max_row(slim, ["id"], "temperature", ["event_id"], by_number("event_id", {"7 seconds": 3, "10 minutes": 200, "1 day": 5000}[width], 600))
    so_far = Window.partitionBy("id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    best = F.max(F.struct("temperature", -F.col("event_id"))).over(so_far)
    expected = slim.select("id", "event_id", best["temperature"].alias("max_temperature"), (-best["col2"]).alias("max_event_id"))
    same(found, expected)


@pytest.mark.parametrize("heavy", HEAVY)
@pytest.mark.parametrize("width", WIDTHS)
def test_rising_runs(events, width, heavy):
    found = patterns.rising_runs(events, ["id"], *ORDER, "temperature", "1 second", width, heavy)
    before = F.lag("temperature").over(ordered(False))
    marked = events.withColumn("falls", F.when(F.col("temperature") < before, 1).otherwise(0)).withColumn(
        "rises", before.isNull() | (F.col("temperature") > before)
    )
    runs = marked.withColumn("nr", F.sum("falls").over(ordered())).groupBy("id", "nr")
    expected = runs.agg(
        F.min(F.when(F.col("rises"), F.col("ts"))).alias("run_start"),
        F.max("ts").alias("run_end"),
        F.sum(F.col("rises").cast("bigint")).alias("n_rises"),
    )
    same(found, expected.where("run_end > run_start").drop("nr"))


@pytest.mark.parametrize("heavy", HEAVY)
@pytest.mark.parametrize("gap", ["3 seconds", "20 seconds", "2 hours"])
def test_sessions(events, gap, heavy):
    found = windows.sessions(events, "ts", gap, ["id"], "event_id", [ones()], heavy)
    native = events.groupBy(F.session_window("ts", gap).alias("w"), "id").agg(F.count(F.lit(1)).alias("n"))
    same(found, native.select("id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n"))


@pytest.mark.parametrize(("size", "slide"), [("1 hour", "5 minutes"), ("9 seconds", "3 seconds"), ("50 seconds", "20 seconds"), ("10 seconds", "10 seconds")])
def test_sliding(events, size, slide):
    found = windows.sliding(events, "ts", size, slide, ["id"], [ones(), Measure("hi", "max", F.col("temperature"))])
    native = events.groupBy(F.window("ts", size, slide).alias("w"), "id").agg(F.count(F.lit(1)).alias("n"), F.max("temperature").alias("hi"))
    same(found, native.select("id", F.col("w.end").alias("window_end"), "n", "hi"))


@pytest.mark.parametrize("heavy", HEAVY)
@pytest.mark.parametrize(("size", "slide"), [(10, 2), (6, 4), (3, 3)])
def test_counted_windows(events, size, slide, heavy):
    found = windows.counted(events, ["id"], ORDER, by_time("ts", "10 minutes", heavy), size, slide, [Measure("total", "sum", F.col("temperature")), ones()])
    last = Window.partitionBy("id").orderBy(*ORDER).rowsBetween(1 - size, 0)
    expected = (
        events.withColumn("nth", F.row_number().over(ordered(False)))
        .withColumn("total", F.sum("temperature").over(last))
        .withColumn("n", F.count(F.lit(1)).over(last))
        .where(F.col("nth") % slide == 0)
        .select("id", F.expr(f"nth div {slide}").alias("firing"), "total", "n")
    )
    same(found, expected)


@pytest.mark.parametrize(("size", "slide"), [("1 hour", "5 minutes"), ("9 seconds", "3 seconds"), ("50 seconds", "20 seconds"), ("1 hour", "7 seconds")])
def test_sliding_whole_numbers(events, size, slide):
    """Whole numbers are summed from changes; zero and negative sums are rows too."""
    signed = Measure("total", "sum", F.when(F.col("status") == "fail", 1).otherwise(-2).cast("bigint"))
    found = windows.sliding(events, "ts", size, slide, ["id"], [ones(), signed])
    native = events.groupBy(F.window("ts", size, slide).alias("w"), "id").agg(F.count(F.lit(1)).alias("n"), F.sum(signed.part).alias("total"))
    same(found, native.select("id", F.col("w.end").alias("window_end"), "n", "total"))


def test_sliding_with_gaps(events):
    """Windows shorter than their slide leave rows out."""
    found = windows.sliding(events, "ts", "4 seconds", "10 seconds", ["id"], [ones()])
    inside = events.where(F.unix_seconds("ts") % 10 < 4).withColumn("end", F.unix_seconds("ts") - F.unix_seconds("ts") % 10 + 4)
    expected = inside.groupBy("id", F.timestamp_seconds("end").alias("window_end")).agg(F.count(F.lit(1)).alias("n"))
    same(found, expected)


@pytest.mark.parametrize("width", ["2 seconds", "1 hour"])
@pytest.mark.parametrize(("times", "inclusive"), [(2, True), (2, False), (3, True)])
def test_consecutive(events, width, times, inclusive):
    failed = F.col("status") == "fail"
    found = patterns.consecutive(events, ["id"], *ORDER, failed, times, "9 seconds", inclusive, width)
    hit, w = failed, ordered(False)
    for i in range(1, times):
        hit = hit & (F.lag("status", i).over(w) == "fail")
    span = F.unix_seconds("ts") - F.unix_seconds("first_ts")
    expected = events.withColumn("hit", hit).withColumn("first_ts", F.lag("ts", times - 1).over(w)).where("hit")
    expected = expected.where(span <= 9 if inclusive else span < 9).select("id", "first_ts", F.col("ts").alias("last_ts"))
    same(found, expected)


@pytest.mark.parametrize("width", ["1 second", "1 hour"])
def test_followed_by(events, width):
    opens, closes = F.col("status") == "success", F.col("temperature") > 15
    kinds = events.where(~(opens & closes))
    found = patterns.followed_by(kinds, ["id"], *ORDER, opens, closes, "15 seconds", width)
    later = kinds.where(closes).select(F.col("id").alias("k"), F.col("ts").alias("t"))
    in_time = F.expr("id = k AND t >= ts AND unix_seconds(t) - unix_seconds(ts) < 15")
    expected = kinds.where(opens).join(later, in_time, "left").groupBy("id", F.col("ts").alias("opened_ts"), "event_id").agg(F.min("t").alias("closed_ts"))
    same(found, expected)


@pytest.mark.parametrize("heavy", HEAVY)
@pytest.mark.parametrize(("within", "width"), [(3, "1 second"), (20, "1 hour"), (3600, "10 minutes")])
def test_bursts(events, within, width, heavy):
    found = patterns.bursts(events.where("id IS NOT NULL"), "id", *ORDER, F.col("status") == "fail", within, 2, width, heavy)
    by_key, expected = {}, []
    for r in events.orderBy(*ORDER).collect():
        if r["id"] is not None:
            by_key.setdefault(r["id"], []).append((int(r["ts"].timestamp()), r["status"]))
    for key, made in by_key.items():
        opened, last, n = None, None, 0
        for at, status in [*made, (10**12, "end")]:
            if opened is not None and at > opened + within:
                expected.append((key, opened, last, n))
                opened, n = None, 0
            if status == "fail":
                opened, last, n = at if opened is None else opened, at, n + 1
            else:
                opened, n = None, 0
    assert sorted(map(tuple, found.collect())) == sorted(e for e in expected if e[3] >= 2)


def sides(events):
    rows = events.where("id IS NOT NULL")
    pays = rows.where("event_id % 2 = 0").select(F.col("id").alias("tx_id"), F.col("event_id").alias("pay_id"), F.col("ts").alias("pay_ts"))
    receipts = rows.where("event_id % 5 = 1").select(F.col("id").alias("tx_id"), F.col("event_id").alias("receipt_id"), F.col("ts").alias("receipt_ts"))
    return pays, receipts


@pytest.mark.parametrize(("low", "high"), [("-3 seconds", "5 seconds"), ("0 seconds", "30 seconds"), ("2 seconds", "4 seconds")])
def test_interval_join_and_reconcile(events, low, high):
    pays, receipts = sides(events)
    other = receipts.withColumnRenamed("tx_id", "k")
    gap = F.unix_micros("receipt_ts") - F.unix_micros("pay_ts")
    near = (F.col("tx_id") == F.col("k")) & gap.between(micros(low), micros(high))
    same(joins.interval_join(pays, receipts, ["tx_id"], "pay_ts", "receipt_ts", low, high), pays.join(other, near).drop("k"))
    full = pays.join(other, near, "full_outer")
    branch = F.expr("CASE WHEN k IS NULL THEN 'unmatched_pay' WHEN tx_id IS NULL THEN 'unmatched_receipt' ELSE 'matched' END")
    expected = full.withColumn("branch", branch).withColumn("tx_id", F.coalesce("tx_id", "k")).drop("k")
    same(joins.reconcile(pays, receipts, ["tx_id"], "pay_ts", "receipt_ts", low, high), expected)


@pytest.mark.parametrize("per_slice", [3, 1000, 10**6])
def test_late_rows(events, per_slice):
    found = lateness.tag_late(events, "event_id", "ts", 60, 20, 600, 1800, per_slice).select("event_id", "is_late")
    before = Window.orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    high = F.max(F.unix_seconds("ts")).over(before)
    end = F.unix_seconds("ts") - F.unix_seconds("ts") % 20 + 60
    same(found, events.select("event_id", F.coalesce(end + 1800 <= high - 600, F.lit(False)).alias("is_late")))


@pytest.mark.parametrize("max_rank", [1, 3, 8])
def test_rank_with_ties(events, max_rank):
    values = events.select("id", "event_id", F.floor("temperature").alias("v"))
    expected = values.withColumn("rank", F.rank().over(Window.partitionBy("id").orderBy(F.desc("v"))))
    same(ranking.top_ranked(values, ["id"], "v", max_rank), expected.where(F.col("rank") <= max_rank))


@pytest.mark.parametrize("partitions", [1, 13])
def test_jobs_do_not_depend_on_partitioning(events, partitions):
    behaviours = events.select("event_id", F.col("id").alias("user_id"), (F.col("temperature") * 2).cast("bigint").alias("item_id"), F.col("status").alias("behaviour"), "ts")
    spread = behaviours.orderBy(F.desc("event_id")).repartition(partitions)
    for job in (
        lambda b: popularity.hot_items(b, "fail"),
        lambda b: traffic.page_views_salted(b, "fail"),
        lambda b: traffic.unique_visitors(b, "fail"),
        lambda b: traffic.unique_visitors_bitmap(b, "fail"),
    ):
        same(job(spread), job(behaviours))


@pytest.mark.parametrize(("within", "width"), [(0, 2), (1, 4), (3, 12), (3, 50), (40, 160)])
def test_chained_windows(spark, within, width):
    """Chains over many slices: gaps up to the bound, a key with one row, a null key, places below zero."""
    draw, made, expected = random.Random(within + width), [], []
    for key, n in ((1, 900), (None, 60), (2, 1)):
        at, chain = -77, []
        for _ in range(n):
            chain.append((key, at, draw.randrange(1, 5)))
            at += draw.randrange(1, max(within, 1) + 1)
        made += chain
        while chain:
            inside = [r for r in chain if r[1] <= chain[0][1] + within]
            expected.append((key, inside[0][1], inside[-1][1], sum(r[2] for r in inside)))
            chain = chain[len(inside) :]
    draw.shuffle(made)
    df = spark.createDataFrame(made, "id bigint, at bigint, n bigint").repartition(5)
    found = chained_windows(df, ["id"], "at", within, width, {"last": F.max("at"), "total": F.sum("n")})
    as_tuples = [(r["id"], r["at"], r["last"], r["total"]) for r in found.collect()]
    assert sorted(as_tuples, key=str) == sorted(expected, key=str)


def test_chained_windows_want_wide_slices(spark):
    with pytest.raises(ValueError, match="too narrow"):
        chained_windows(spark.range(1).withColumn("at", F.col("id")), ["id"], "at", 10, 30, {"last": F.max("at")})
