"""Streaming forms. Each replays the events table as a stream and must equal its batch twin's SQL.

The replay ends with a row at the end of time, which closes every window, timer and interval. Its
watermarks wait as long as the files are out of time order, so no row is late, whatever the batches.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.durations import micros
from tidemark.operators.aggregates import count_by
from tidemark.operators.branch import without_static, words
from tidemark.operators.joins import interval_join
from tidemark.operators.sequences import Measure
from tidemark.operators.windows import epoch, sessions, sliding, tumbling
from tidemark.plans import alerts, sync
from tidemark.session import scratch_dir
from tidemark.sinks import delivery, keyed
from tidemark.sources.external import change_records
from tidemark.sources.files import access_log
from tidemark.sources.streams import file_stream
from tidemark.streaming import processors
from tidemark.streaming import windows as streamed
from tidemark.streaming.lateness import late_each_batch, read_rows
from tidemark.streaming.runner import (
    disorder,
    run_batches_to_table,
    run_each_batch,
    run_to_table,
    stream_session,
    table_stream,
    with_end,
)
from tidemark.tables import (
    as_actions,
    as_arrivals,
    as_behaviours,
    as_change_values,
    as_log_lines,
    as_logins,
    as_orders_and_payments,
    as_readings,
    load,
    side,
)
from workload.eventtime import (
    AVERAGES,
    BURSTS,
    CHANNELS,
    JUMPS,
    LATE,
    LATENESS,
    MIN_ROWS,
    NUMBERS,
    PAGE_VIEWS,
    RUNS,
    SESSIONS,
    SYNC,
    TIMEOUTS,
    login_warnings,
    min_row_aggregate,
    min_rows,
    session_rows,
    timeout_rows,
)
from workload.grouping import BIT, HOT_ITEMS, HOT_PAGES, PAYS, RECEIPTS, RECONCILED, WORD_COUNT, ranked_rows, reconciled_rows
from workload.registry import BEHAVIOURS, HOUR, READINGS, SQL, query


def events(spark, folder, event_type="view", **values):
    """The events as a stream, its end (a row that passes the query's filter) and the watermark's delay."""
    stream = table_stream(stream_session(spark), folder, "events")
    stream, end = with_end(stream, "ts", event_id=-1, event_type=event_type, props='{"k": -1}', **values)
    return stream, end, disorder(spark, f"{folder}/events.parquet", "ts")


@query(
    "stream_replayed_batches",
    "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
)
def stream_replayed_batches(spark, folder):
    """A queue of batches replayed one file at a time; every batch is merged into running totals."""
    path = scratch_dir(spark, "queue")
    load(spark, folder, "events").select("event_id", "event_type").repartition(4).write.parquet(path)
    session = stream_session(spark)
    stream = file_stream(session, path, "event_id bigint, event_type string", files_per_batch=1)
    totals = scratch_dir(spark, "totals")
    run_each_batch(
        stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")),
        spark,
        keyed.merge_each_batch(totals, ["event_type"], ["n"]),
    )
    return keyed.read_keyed(spark, totals, ["event_type"], ["n"])


@query("stream_word_count", WORD_COUNT)
def stream_word_count(spark, folder):
    """Word totals kept in state; each batch's changed words replace their rows in a keyed table."""
    documents = table_stream(stream_session(spark), folder, "documents")
    counts = count_by(words(documents.select("text"), "text"), ["word"])
    totals = scratch_dir(spark, "totals")
    run_each_batch(counts, spark, keyed.merge_each_batch(totals, ["word"], ["n"]))
    return keyed.read_keyed(spark, totals, ["word"], ["n"])


@query("stream_hot_items", HOT_ITEMS)
def stream_hot_items(spark, folder):
    stream, end, delay = events(spark, folder)
    seen = as_behaviours(stream).where("behaviour = 'view'")
    counts = streamed.window_counts(seen, "ts", delay, "1 hour", "5 minutes", ["item_id"])
    return ranked_rows(run_batches_to_table(counts, spark, streamed.ranked_windows("item_id", 5), [end]), "item_id")


@query("stream_hot_pages", HOT_PAGES)
def stream_hot_pages(spark, folder):
    """Access-log lines as a stream. Their times are whole seconds, so the watermark waits a second more."""
    stream = table_stream(stream_session(spark), folder, "events")
    stream, end = with_end(stream, "ts", event_id=-1, event_type="view", user_id=0, props='{"k": 0}')
    delay = micros(disorder(spark, f"{folder}/events.parquet", "ts")) + micros("1 second")
    pages = without_static(access_log(as_log_lines(stream)).where("method = 'GET'"), "url")
    counts = streamed.window_counts(pages, "ts", f"{delay} microseconds", "10 minutes", "1 minute", ["url"])
    return ranked_rows(run_batches_to_table(counts, spark, streamed.ranked_windows("url", 3), [end]), "url")


@query("stream_page_views", PAGE_VIEWS)
def stream_page_views(spark, folder):
    """Salted counts per window, then a second stage that adds them up."""
    stream, end, delay = events(spark, folder)
    seen = as_behaviours(stream).where("behaviour = 'view'")
    salted = seen.withColumn("salt", F.pmod(F.xxhash64("event_id"), F.lit(10)))
    counts = streamed.window_counts(salted, "ts", delay, "1 hour", None, ["salt"])
    total = counts.groupBy("window").agg(F.sum("n").alias("n")).select(epoch(F.col("window.end")).alias("window_end"), "n")
    return run_to_table(total, spark, [end])


@query(
    "stream_unique_visitors",
    f"""SELECT (us // {HOUR} + 1) * 3600 AS window_end, count(DISTINCT user_id) AS uv
        FROM {BEHAVIOURS} WHERE behaviour = 'view' GROUP BY 1""",
)
def stream_unique_visitors(spark, folder):
    stream, end, delay = events(spark, folder, user_id=-1)
    seen = as_behaviours(stream).where("behaviour = 'view'")
    found = run_to_table(streamed.distinct_users(seen, "ts", delay, "1 hour", "user_id"), spark, [end])
    return found.select(epoch("window_end").alias("window_end"), "uv")


@query(
    "stream_unique_visitors_bitmap",
    f"""SELECT (us // {HOUR} + 1) * 3600 AS window_end, count(DISTINCT {BIT}) AS uv
        FROM {BEHAVIOURS} WHERE behaviour = 'view' GROUP BY 1""",
)
def stream_unique_visitors_bitmap(spark, folder):
    stream, end, delay = events(spark, folder, user_id=-1)
    seen = as_behaviours(stream).where("behaviour = 'view'")
    found = run_to_table(streamed.distinct_users(seen, "ts", delay, "1 hour", "user_id", bitmap=True), spark, [end])
    return found.select(epoch("window_end").alias("window_end"), "uv")


@query("stream_refreshed_views", PAGE_VIEWS)
def stream_refreshed_views(spark, folder):
    """A count refreshed by every batch instead of once at the window's end; late rows refine it."""
    seen = as_behaviours(table_stream(stream_session(spark), folder, "events")).where("behaviour = 'view'")
    delay = disorder(spark, f"{folder}/events.parquet", "ts")
    counts = streamed.window_counts(seen, "ts", delay, "1 hour", None, [])
    refreshed = counts.select(epoch(F.col("window.end")).alias("window_end"), "n")
    totals = scratch_dir(spark, "totals")
    run_each_batch(refreshed, spark, keyed.merge_each_batch(totals, ["window_end"], ["n"]))
    return keyed.read_keyed(spark, totals, ["window_end"], ["n"])


@query("stream_channel_counts", CHANNELS)
def stream_channel_counts(spark, folder):
    stream, end, delay = events(spark, folder, user_id=0)
    actions = as_actions(stream).where("behaviour <> 'error'").withWatermark("ts", delay)
    one = Measure("n", "sum", F.lit(1).cast("bigint"))
    found = run_to_table(sliding(actions, "ts", "1 hour", "5 minutes", ["channel", "behaviour"], [one]), spark, [end])
    return found.select("channel", "behaviour", epoch("window_end").alias("window_end"), "n")


@query("stream_channel_counts_fine", SQL["channel_counts_fine"])
def stream_channel_counts_fine(spark, folder):
    """One hour every five seconds: a window is the one before, plus the pane that came in, less the one that dropped out."""
    stream, end, delay = events(spark, folder, user_id=0)
    actions = as_actions(stream).where("behaviour <> 'error'").withWatermark("ts", delay)
    sums = streamed.sliding_sums(actions, "ts", "1 hour", "5 seconds", ["channel", "behaviour"], {"n": F.lit(1)})
    return run_to_table(sums, spark, [end]).groupBy("channel", "behaviour").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("n").alias("total"), F.max("n").alias("most")
    )


@query("stream_sliding_batch_sums", SQL["sliding_batch_sums"])
def stream_sliding_batch_sums(spark, folder):
    """Sums over the last three batches of a stream, in cents, so that what drops out can be taken off exactly."""
    stream, end, delay = events(spark, folder, value=0.0)
    cents = F.round(F.col("value") * 100).cast("bigint")
    rows = stream.withWatermark("ts", delay)
    sums = streamed.sliding_sums(rows, "ts", "9 seconds", "3 seconds", ["event_type"], {"n": F.lit(1), "cents": cents})
    found = run_to_table(sums, spark, [end])
    return found.select(
        "event_type", epoch("window_end").alias("window_end"), "n", F.round(F.col("cents") / 100, 2).alias("total")
    )


@query(
    "stream_retract_counts",
    "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def stream_retract_counts(spark, folder):
    """Counts told as changes, four files one by one; the replayed changes are the table."""
    path = scratch_dir(spark, "queue")
    load(spark, folder, "events").select("user_id", "event_type").repartition(4).write.parquet(path)
    stream = file_stream(stream_session(spark), path, "user_id bigint, event_type string", files_per_batch=1)
    changes = streamed.retractions(stream, ["user_id", "event_type"], {"n": F.lit(1)})
    return streamed.replayed_changes(run_to_table(changes, spark))


class BreaksInSecondLot(delivery.LotFiles):
    """A target that fails in the middle of each delivery."""

    def put(self, name, rows):
        if name.endswith("lot-1"):
            raise ConnectionError(name)
        super().put(name, rows)


@query("stream_delivered_lots", "SELECT event_id, user_id, event_type FROM events")
def stream_delivered_lots(spark, folder):
    """Rows delivered in lots of 1000. The first run breaks in its second lot; the next repeats the batch and goes on."""
    schema = "event_id bigint, user_id bigint, event_type string"
    queue, path, ledger, checkpoint = (scratch_dir(spark, name) for name in ("queue", "lots", "ledger", "checkpoint"))
    load(spark, folder, "events").select("event_id", "user_id", "event_type").repartition(4).write.parquet(queue)
    stream = file_stream(stream_session(spark), queue, schema, files_per_batch=1)
    for target in (BreaksInSecondLot(path), delivery.LotFiles(path)):
        send = delivery.deliver_each_batch(target, ledger, retries=1, pause=0.01)
        try:
            run_each_batch(stream, spark, send, mode="append", checkpoint=checkpoint)
        except StreamingQueryException as broken:  # not where a file holds no second lot
            if "lot-1" not in str(broken):
                raise
    return delivery.read_delivered(spark, path, ledger, schema)


@query("stream_min_row", MIN_ROWS)
def stream_min_row(spark, folder):
    stream, end, delay = events(spark, folder, user_id=-1, value=0.0)
    rows = as_readings(stream).withWatermark("ts", delay)
    return min_rows(run_to_table(tumbling(rows, "ts", "6 hours", ["id"], [min_row_aggregate()]), spark, [end]))


@query("stream_sessions", SESSIONS)
def stream_sessions(spark, folder):
    stream, end, delay = events(spark, folder, user_id=-1)
    rows = as_readings(stream).withWatermark("ts", delay)
    one = Measure("n", "sum", F.lit(1).cast("bigint"))
    return session_rows(run_to_table(sessions(rows, "ts", "5 hours", ["id"], "event_id", [one]), spark, [end]))


def _halves(spark, folder, *event_types):
    """Event types as separate streams with their ends, whose keys match nothing."""
    session = stream_session(spark)
    for key, event_type in enumerate(event_types, 1):
        stream = table_stream(session, folder, "events")
        whole, end = with_end(stream, "ts", event_id=-1, event_type=event_type, user_id=-key)
        yield whole, end


def _sides(spark, folder):
    (pays, pay_end), (receipts, receipt_end) = _halves(spark, folder, "click", "view")
    delay = disorder(spark, f"{folder}/events.parquet", "ts")
    return (
        side(pays, "click", "pay").withWatermark("pay_ts", delay),
        side(receipts, "view", "receipt").withWatermark("receipt_ts", delay),
        [pay_end, receipt_end],
    )


@query(
    "stream_interval_pairs",
    f"""SELECT tx_id, pay_id, receipt_id FROM {PAYS} JOIN {RECEIPTS} USING (tx_id)
        WHERE receipt_us BETWEEN pay_us - {3 * HOUR} AND pay_us + {5 * HOUR}""",
)
def stream_interval_pairs(spark, folder):
    pays, receipts, ends = _sides(spark, folder)
    pairs = interval_join(pays, receipts, ["tx_id"], "pay_ts", "receipt_ts", "-3 hours", "5 hours")
    return run_to_table(pairs.select("tx_id", "pay_id", "receipt_id"), spark, ends)


@query("stream_reconcile_payments", RECONCILED)
def stream_reconcile_payments(spark, folder):
    pays, receipts, ends = _sides(spark, folder)
    found = streamed.reconciled(pays, receipts, "tx_id", "pay_ts", "receipt_ts", "-3 hours", "5 hours")
    return reconciled_rows(run_to_table(found, spark, ends))


@query(
    "stream_window_pairs",
    f"""SELECT tx_id, pay_id, receipt_id FROM {PAYS} JOIN {RECEIPTS} USING (tx_id)
        WHERE pay_us // {6 * HOUR} = receipt_us // {6 * HOUR}""",
)
def stream_window_pairs(spark, folder):
    """Two streams joined batch by batch: on key and time window."""
    pays, receipts, ends = _sides(spark, folder)
    left = pays.withColumn("window", F.window("pay_ts", "6 hours"))
    right = receipts.withColumn("window", F.window("receipt_ts", "6 hours"))
    pairs = left.join(right, ["tx_id", "window"]).select("tx_id", "pay_id", "receipt_id")
    return run_to_table(pairs, spark, ends)


def _ordered(spark, folder, rows_of, apply, event_type="click"):
    """Keyed processors sort a key's rows of one batch in memory, so batches are smaller."""
    stream = table_stream(stream_session(spark), folder, "events", gigabytes_per_batch=1)
    whole, end = with_end(stream, "ts", event_id=-1, event_type=event_type, user_id=-1, value=0.0)
    rows = rows_of(whole).withWatermark("ts", disorder(spark, f"{folder}/events.parquet", "ts"))
    return run_to_table(apply(rows), spark, [end])


def _processed(spark, folder, rows_of, key, processor):
    return _ordered(spark, folder, rows_of, lambda rows: processors.apply_processor(rows, key, processor))


@query("stream_payment_timeouts", TIMEOUTS)
def stream_payment_timeouts(spark, folder):
    """Orders wait in state for their payment, which may arrive before them."""
    kind = F.col("event_type")
    apply = lambda rows: streamed.first_closing(rows, "order_id", "ts", kind == "create", kind == "pay", "1 day", "16 days")
    return timeout_rows(alerts.with_result(_ordered(spark, folder, as_orders_and_payments, apply, "signup"), "1 day"))


def _failures(spark, folder, n, within, inclusive=True):
    apply = lambda rows: streamed.consecutive(rows, "user_id", "ts", F.col("status") == "fail", n, within, inclusive)
    return login_warnings(_ordered(spark, folder, as_logins, apply))


@query("stream_login_failures", SQL["login_failures"])
def stream_login_failures(spark, folder):
    return _failures(spark, folder, 2, "2 hours")


@query("stream_login_failure_pattern", SQL["login_failure_pattern"])
def stream_login_failure_pattern(spark, folder):
    return _failures(spark, folder, 2, "2 hours", inclusive=False)


@query("stream_login_failures_three", SQL["login_failures_three"])
def stream_login_failures_three(spark, folder):
    return _failures(spark, folder, 3, "1 day")


@query("stream_running_count", NUMBERS)
def stream_running_count(spark, folder):
    return _processed(spark, folder, as_readings, "id", processors.RunningCount())


@query("stream_jumps", JUMPS)
def stream_jumps(spark, folder):
    return _processed(spark, folder, as_readings, "id", processors.Jumps(10.0))


@query("stream_rolling_averages", AVERAGES)
def stream_rolling_averages(spark, folder):
    found = _processed(spark, folder, as_readings, "id", processors.CountedAverage(10, 2))
    return found.select("id", "firing", F.round("avg_temp", 6).alias("avg_temp"))


@query(
    "stream_kind_profile",
    """SELECT user_id AS id, event_id, event_type AS kind,
              row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth_of_kind,
              max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS highest
       FROM events""",
)
def stream_kind_profile(spark, folder):
    """Map state (counts by kind) and reducing state (highest value) of each user."""
    rows_of = lambda events: events.select(
        F.col("user_id").alias("id"), "event_id", "ts", F.col("event_type").alias("kind"), F.col("value").alias("temperature")
    )
    return _processed(spark, folder, rows_of, "id", processors.KindProfile())


@query("stream_rising_alerts", f"SELECT id, run_start FROM {RUNS}")
def stream_rising_alerts(spark, folder):
    found = _processed(spark, folder, as_readings, "id", processors.RisingAlert(micros("12 hours")))
    return found.select("id", F.unix_micros("run_start").alias("run_start"))


@query(
    "stream_silence_timer",
    f"""SELECT id, s AS last_second FROM (SELECT id, us // 1000000 AS s,
            lead(us // 1000000) OVER (PARTITION BY id ORDER BY us, event_id) AS next FROM {READINGS})
        WHERE next IS NULL OR next - s > {6 * 3600}""",
)
def stream_silence_timer(spark, folder):
    """Timers set by every reading and run out after six silent hours."""
    return _processed(spark, folder, as_readings, "id", processors.SilenceTimer(6 * 3600))


@query("stream_login_bursts", BURSTS)
def stream_login_bursts(spark, folder):
    return _processed(spark, folder, as_logins, "user_id", processors.FailBursts(6 * 3600))


@query("stream_late_rows", LATE)
def stream_late_rows(spark, folder):
    arrived = as_arrivals(table_stream(stream_session(spark), folder, "events"))
    path = scratch_dir(spark, "late")
    names = ("arrival", "ts", "size", "slide", "disorder", "lateness")
    split = late_each_batch(path, tie="event_id", **dict(zip(names, LATENESS, strict=True)))
    run_each_batch(arrived, spark, split, mode="append")
    return read_rows(spark, path).select("event_id", "is_late")


@query("stream_change_sync", SYNC)
def stream_change_sync(spark, folder):
    """Change records merged batch by batch into last images, read as wide rows."""
    values = as_change_values(table_stream(stream_session(spark), folder, "events"))
    changes = change_records(values, "id bigint, name string, age int")
    path = scratch_dir(spark, "images")
    run_each_batch(changes, spark, sync.sync_each_batch(path, "id", ["event_id"]), mode="append")
    rows = sync.read_synchronised(spark, path, "id", ["event_id"], "cf1", ["name", "age"])
    return rows.select("id", F.to_json("cf1").alias("cf1"))
