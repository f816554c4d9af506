"""Time windows, lateness, event patterns, sensor alerts, change application."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.aggregates import sketch_bound
from tidemark.operators.lateness import tag_late
from tidemark.operators.sequences import Measure
from tidemark.operators.windows import epoch, sessions, sliding, tumbling
from tidemark.plans import alerts, sync, traffic
from tidemark.session import scratch_dir
from tidemark.sources.external import change_records
from tidemark.tables import (
    as_actions,
    as_behaviours,
    as_arrivals,
    as_change_values,
    behaviours,
    load,
    logins,
    orders_and_payments,
    readings,
)
from workload.inputs import CHANGES
from workload.registry import BEHAVIOURS, DAY, HOUR, LOGINS, READINGS, SECONDS, query

ENDS = "unnest(generate_series(us // {slide} * {slide} + {slide}, us // {slide} * {slide} + {size}, {slide})) // 1000000"

PAGE_VIEWS = f"""SELECT (us // {HOUR} + 1) * 3600 AS window_end, count(*) AS n
    FROM {BEHAVIOURS} WHERE behaviour = 'view' GROUP BY 1"""


def counted_ends(found):
    return found.select(epoch("window_end").alias("window_end"), "n")


@query("page_views", PAGE_VIEWS)
def page_views(spark, folder):
    return counted_ends(traffic.page_views(behaviours(spark, folder), "view"))


@query("page_views_salted", PAGE_VIEWS)
def page_views_salted(spark, folder):
    return counted_ends(traffic.page_views_salted(behaviours(spark, folder), "view"))


MIN_ROWS = f"""SELECT id, (us // {6 * HOUR} + 1) * 21600 AS window_end, min(temperature) AS temperature,
    arg_min(event_id, (temperature, us, event_id)) AS event_id FROM {READINGS} GROUP BY 1, 2"""


def min_rows(windowed):
    return windowed.select(
        "id", epoch("window_end").alias("window_end"), F.col("_row.temperature").alias("temperature"), "_row.event_id"
    )


def min_row_aggregate():
    return F.min_by(F.struct("temperature", "event_id"), F.struct("temperature", "ts", "event_id")).alias("_row")


@query("tumbling_min_row", MIN_ROWS)
def tumbling_min_row(spark, folder):
    """The coldest reading of each sensor and window, as a whole row; ties to the earliest."""
    return min_rows(tumbling(readings(spark, folder), "ts", "6 hours", ["id"], [min_row_aggregate()]))


@query(
    "tumbling_sql",
    f"""SELECT id, count(*) AS n, round(avg(temperature), 6) AS avg_temp, (us // {DAY} + 1) * 86400 AS window_end
        FROM {READINGS} GROUP BY id, 4""",
)
def tumbling_sql(spark, folder):
    """Windows named in SQL, on a table with an event-time and a processing-time column."""
    with_times = readings(spark, folder).withColumnRenamed("ts", "rt").withColumn("pt", F.current_timestamp())
    with_times.createOrReplaceTempView("sensor")
    return spark.sql(
        """SELECT id, count(id) AS n, round(avg(temperature), 6) AS avg_temp, unix_seconds(window.end) AS window_end
           FROM (SELECT window(rt, '1 day') AS window, id, temperature FROM sensor WHERE pt IS NOT NULL)
           GROUP BY id, window"""
    )


@query(
    "batch_interval_counts",
    "SELECT event_type, (epoch_us(ts) // 6000000 + 1) * 6 AS window_end, count(*) AS n FROM events GROUP BY 1, 2",
)
def batch_interval_counts(spark, folder):
    """Counts per 6-second batch of a stream."""
    counts = tumbling(load(spark, folder, "events"), "ts", "6 seconds", ["event_type"], [F.count(F.lit(1)).alias("n")])
    return counts.select("event_type", epoch("window_end").alias("window_end"), "n")


@query(
    "global_window_function",
    f"""SELECT (us // {HOUR} + 1) * 3600 AS window_end, count(*) AS n, max(temperature) AS highest,
               max(us) // 1000000 - min(us) // 1000000 AS spread FROM {READINGS} GROUP BY 1""",
)
def global_window_function(spark, folder):
    """A function over all rows of a window without key, as mergeable aggregates instead of a buffer."""
    spread = (F.max(F.unix_seconds("ts")) - F.min(F.unix_seconds("ts"))).alias("spread")
    aggregates = [F.count(F.lit(1)).alias("n"), F.max("temperature").alias("highest"), spread]
    return tumbling(readings(spark, folder), "ts", "1 hour", [], aggregates).select(
        epoch("window_end").alias("window_end"), "n", "highest", "spread"
    )


CHANNELS = f"""SELECT channel, behaviour, window_end, count(*) AS n FROM (SELECT
        CASE user_id % 3 WHEN 0 THEN 'app store' WHEN 1 THEN 'wechat' ELSE 'weibo' END AS channel, behaviour,
        {ENDS.format(slide=300 * SECONDS, size=HOUR)} AS window_end FROM {BEHAVIOURS} WHERE behaviour <> 'error')
    GROUP BY ALL"""


@query("channel_counts", CHANNELS)
def channel_counts(spark, folder):
    actions = as_actions(load(spark, folder, "events"))
    counts = traffic.channel_counts(actions, "error", slide="5 minutes")
    return counts.select("channel", "behaviour", epoch("window_end").alias("window_end"), "n")


@query(
    "unique_visitors_sketch",
    f"""SELECT window_end, count(DISTINCT user_id) AS uv, true AS within_bound
        FROM (SELECT user_id, {ENDS.format(slide=6 * HOUR, size=DAY)} AS window_end FROM {BEHAVIOURS} WHERE behaviour = 'view')
        GROUP BY 1""",
)
def unique_visitors_sketch(spark, folder):
    """Visitors of a day, every six hours, from hourly sketches that two runs stored, next to the exact numbers."""
    seen = as_behaviours(load(spark, folder, "events"))
    path = scratch_dir(spark, "sketches")
    for run in range(2):
        share = seen.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == run)
        traffic.visitor_sketches(share, "view").write.mode("append").parquet(path)
    estimated = traffic.visitors_from_sketches(spark.read.parquet(path)).withColumnRenamed("uv", "estimate")
    window = F.window("ts", "1 day", "6 hours")
    exact = seen.where("behaviour = 'view'").groupBy(window.end.alias("window_end")).agg(F.count_distinct("user_id").alias("uv"))
    bound = F.lit(sketch_bound()) * F.col("uv") + 0.5  # estimates are whole numbers
    compared = exact.join(estimated, "window_end", "full")
    within = F.coalesce(F.abs(F.col("estimate") - F.col("uv")) <= bound, F.lit(False)).alias("within_bound")
    return compared.select(epoch("window_end").alias("window_end"), "uv", within)


@query(
    "sliding_batch_sums",
    f"""SELECT event_type, window_end, count(*) AS n, round(sum(value), 2) AS total
        FROM (SELECT event_type, value, {ENDS.format(slide=3 * SECONDS, size=9 * SECONDS)} AS window_end
              FROM (SELECT *, epoch_us(ts) AS us FROM events)) GROUP BY ALL""",
)
def sliding_batch_sums(spark, folder):
    """Sums over the last three batches of a stream, kept by batch and not by row."""
    measures = [Measure("n", "sum", F.lit(1).cast("bigint")), Measure("total", "sum", F.col("value"))]
    found = sliding(load(spark, folder, "events"), "ts", "9 seconds", "3 seconds", ["event_type"], measures)
    return found.select("event_type", epoch("window_end").alias("window_end"), "n", F.round("total", 2).alias("total"))


SESSIONS = f"""SELECT id, min(us) AS session_start, max(us) + {5 * HOUR} AS session_end, count(*) AS n
    FROM (SELECT *, sum(starts) OVER (PARTITION BY id ORDER BY us ROWS UNBOUNDED PRECEDING) AS nr
        FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY id ORDER BY us) <= {5 * HOUR} THEN 0 ELSE 1 END AS starts
              FROM {READINGS}))
    GROUP BY id, nr"""


def session_rows(found):
    return found.select(
        "id", F.unix_micros("session_start").alias("session_start"), F.unix_micros("session_end").alias("session_end"), "n"
    )


@query("session_windows", SESSIONS)
def session_windows(spark, folder):
    one = Measure("n", "sum", F.lit(1).cast("bigint"))
    return session_rows(sessions(readings(spark, folder), "ts", "5 hours", ["id"], "event_id", [one]))


ARRIVALS = "(SELECT event_id, event_id + (event_id * 7919) % 50 AS arrival, epoch_us(ts) AS us FROM events)"


LATE = f"""SELECT event_id, coalesce((us // {HOUR} + 1) * {HOUR} + {HOUR // 60} <= highest - {HOUR // 2}, false) AS is_late
    FROM (SELECT *, max(us) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
          AS highest FROM {ARRIVALS})"""

LATENESS = ("arrival", "ts", "1 hour", "1 hour", "30 minutes", "1 minute")


@query("late_rows", LATE)
def late_rows(spark, folder):
    """Rows in a disordered arrival order, split into those in time and those late for their hour."""
    tagged = tag_late(as_arrivals(load(spark, folder, "events")), *LATENESS, tie="event_id")
    return tagged.select("event_id", "is_late")


def _login_sql(lags: int, bound: str) -> str:
    order = "PARTITION BY user_id ORDER BY s, event_id"
    fails = " AND ".join(["status = 'fail'", *[f"lag_{i} = 'fail'" for i in range(1, lags + 1)]])
    lagged = ", ".join(f"lag(status, {i}) OVER ({order}) AS lag_{i}" for i in range(1, lags + 1))
    return f"""SELECT user_id, first AS first_second, s AS last_second FROM (SELECT *, {lagged},
        lag(s, {lags}) OVER ({order}) AS first FROM {LOGINS}) WHERE {fails} AND s - first {bound}"""


def login_warnings(found):
    return found.select("user_id", epoch("first_ts").alias("first_second"), epoch("last_ts").alias("last_second"))


@query("login_failures", _login_sql(1, "<= 7200"))
def login_failures(spark, folder):
    return login_warnings(alerts.login_failures(logins(spark, folder), 2, "2 hours"))


@query("login_failure_pattern", _login_sql(1, "< 7200"))
def login_failure_pattern(spark, folder):
    return login_warnings(alerts.login_failures(logins(spark, folder), 2, "2 hours", inclusive=False))


@query("login_failures_three", _login_sql(2, "<= 86400"))
def login_failures_three(spark, folder):
    return login_warnings(alerts.login_failures(logins(spark, folder), 3, "1 day"))


BURSTS = f"""WITH RECURSIVE logged AS (
        SELECT user_id, s, status, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) AS nr FROM {LOGINS}),
    ended AS (
        SELECT user_id, s, status, nr FROM logged
        UNION ALL SELECT user_id, 99999999999 AS s, 'end' AS status, max(nr) + 1 AS nr FROM logged GROUP BY user_id),
    state AS (
        SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS nr, CAST(NULL AS BIGINT) AS opened, CAST(NULL AS BIGINT) AS last,
               CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS done_first, CAST(NULL AS BIGINT) AS done_last,
               CAST(0 AS BIGINT) AS done_n FROM logged
        UNION ALL
        SELECT e.user_id, e.nr,
               CASE WHEN e.status <> 'fail' THEN NULL WHEN opened IS NULL OR e.s > opened + {6 * 3600} THEN e.s ELSE opened END,
               CASE WHEN e.status <> 'fail' THEN NULL ELSE e.s END,
               CASE WHEN e.status <> 'fail' THEN 0 WHEN opened IS NULL OR e.s > opened + {6 * 3600} THEN 1 ELSE n + 1 END,
               opened, last, CASE WHEN e.s > opened + {6 * 3600} THEN n ELSE 0 END
        FROM state JOIN ended e ON e.user_id = state.user_id AND e.nr = state.nr + 1)
    SELECT user_id, done_first AS first_second, done_last AS last_second, done_n AS n_fails FROM state WHERE done_n >= 2"""


@query("login_bursts", BURSTS)
def login_bursts(spark, folder):
    return alerts.login_bursts(logins(spark, folder), 6 * 3600)


TIMEOUTS = f"""SELECT c.order_id, c.us // 1000000 AS opened, c.event_id,
        CASE WHEN min(p.us) IS NOT NULL THEN 'payed' ELSE 'timeout:' || ((c.us + {DAY}) // 1000) END AS result
    FROM (SELECT user_id AS order_id, epoch_us(ts) AS us, event_id FROM events WHERE event_type = 'signup') c
    LEFT JOIN (SELECT user_id AS order_id, epoch_us(ts) AS us FROM events WHERE event_type = 'purchase') p
        ON c.order_id = p.order_id AND p.us >= c.us AND p.us < c.us + {DAY}
    GROUP BY c.order_id, c.us, c.event_id"""


def timeout_rows(found):
    return found.select("order_id", epoch("opened_ts").alias("opened"), "event_id", "result")


@query("payment_timeouts", TIMEOUTS)
def payment_timeouts(spark, folder):
    return timeout_rows(alerts.payment_timeouts(orders_and_payments(spark, folder), "1 day"))


JUMPS = f"""SELECT id, before, temperature AS after FROM (SELECT *,
    lag(temperature) OVER (PARTITION BY id ORDER BY us, event_id) AS before FROM {READINGS})
    WHERE abs(temperature - before) >= 10"""


@query("temperature_jumps", JUMPS)
def temperature_jumps(spark, folder):
    return alerts.temperature_jumps(readings(spark, folder)).select("id", "before", "after")


# A fall ends a run. The next one starts at the first reading above its predecessor; equal readings neither start nor end one.
RISES = """(SELECT id, min(us) FILTER (rises) AS run_start, max(us) AS run_end, CAST(count(*) FILTER (rises) AS BIGINT) AS n_rises
    FROM (SELECT *, sum(falls) OVER (PARTITION BY id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS nr
        FROM (SELECT *, before IS NULL OR temperature > before AS rises, CASE WHEN temperature < before THEN 1 ELSE 0 END AS falls
            FROM (SELECT *, lag(temperature) OVER (PARTITION BY id ORDER BY us, event_id) AS before FROM {readings})))
    GROUP BY id, nr HAVING max(us) - min(us) FILTER (rises) >= {least})"""
RUNS = RISES.format(readings=READINGS, least=12 * HOUR)


def rise_rows(found):
    return found.select(
        "id", F.unix_micros("run_start").alias("run_start"), F.unix_micros("run_end").alias("run_end"), "n_rises"
    )


@query("temperature_rises", f"SELECT id, run_start, run_end, n_rises FROM {RUNS}")
def temperature_rises(spark, folder):
    return rise_rows(alerts.temperature_rises(readings(spark, folder), "12 hours"))


FLAT = f"(SELECT id, ts, us, floor(temperature / 40) AS temperature, event_id FROM {READINGS})"


@query(
    "temperature_rises_flat",
    f"SELECT id, run_start, run_end, n_rises FROM {RISES.format(readings=FLAT, least=12 * HOUR)}",
)
def temperature_rises_flat(spark, folder):
    """Readings in coarse steps, so that many neighbours are equal."""
    flat = readings(spark, folder).withColumn("temperature", F.floor(F.col("temperature") / 40))
    return rise_rows(alerts.temperature_rises(flat, "12 hours"))


@query(
    "payment_timeouts_ties",
    f"""SELECT coalesce(c.order_id, -1) AS order_id, c.s AS opened, c.event_id,
        CASE WHEN min(p.s) IS NOT NULL THEN 'payed' ELSE 'timeout:' || ((c.s + {6 * 3600}) * 1000) END AS result
    FROM (SELECT nullif(user_id % 50, 7) AS order_id, epoch_us(ts) // {HOUR} * 3600 AS s, event_id FROM events
          WHERE event_type = 'signup') c
    LEFT JOIN (SELECT nullif(user_id % 50, 7) AS order_id, epoch_us(ts) // {HOUR} * 3600 AS s FROM events
               WHERE event_type = 'purchase') p ON c.order_id = p.order_id AND p.s >= c.s AND p.s < c.s + {6 * 3600}
    GROUP BY c.order_id, c.s, c.event_id""",
)
def payment_timeouts_ties(spark, folder):
    """Orders and payments by the full hour, so that many are equally timed, some without an order."""
    orders = orders_and_payments(spark, folder).withColumns(
        {
            "order_id": F.nullif(F.col("order_id") % 50, F.lit(7)),
            "ts": F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 3600) * 3600),
        }
    )
    return timeout_rows(alerts.payment_timeouts(orders, "6 hours")).fillna(-1, "order_id")


NUMBERS = f"SELECT id, event_id, row_number() OVER (PARTITION BY id ORDER BY us, event_id) AS nth FROM {READINGS}"


@query("reading_numbers", NUMBERS)
def reading_numbers(spark, folder):
    return alerts.reading_numbers(readings(spark, folder)).select("id", "event_id", "nth")


AVERAGES = f"""SELECT id, nth // 2 AS firing, round(avg_temp, 6) AS avg_temp FROM (SELECT id,
    row_number() OVER (PARTITION BY id ORDER BY us, event_id) AS nth,
    avg(temperature) OVER (PARTITION BY id ORDER BY us, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS avg_temp
    FROM {READINGS}) WHERE nth % 2 = 0"""


@query("rolling_averages", AVERAGES)
def rolling_averages(spark, folder):
    found = alerts.rolling_averages(readings(spark, folder), 10, 2)
    return found.select("id", "firing", F.round("avg_temp", 6).alias("avg_temp"))


SYNC = f"""SELECT id, '{{"name":"' || name || '","age":' || age || '}}' AS cf1 FROM (SELECT *,
    row_number() OVER (PARTITION BY id ORDER BY event_id DESC) AS rn FROM {CHANGES}) WHERE rn = 1 AND type <> 'delete'"""


@query("change_sync", SYNC)
def change_sync(spark, folder):
    """A change log applied: the last image of each key as (id, column family) rows."""
    values = as_change_values(load(spark, folder, "events"))
    changes = change_records(values, "id bigint, name string, age int")
    rows = sync.synchronised(changes, "id", ["event_id"], "cf1", ["name", "age"])
    return rows.select("id", F.to_json("cf1").alias("cf1"))


@query("temperature_jumps_sliced", JUMPS)
def temperature_jumps_sliced(spark, folder):
    """As the plain form, with every key taken as a heavy one; so are the next four."""
    return alerts.temperature_jumps(readings(spark, folder), width="6 hours", heavy_rows=1).select("id", "before", "after")


@query("temperature_rises_sliced", f"SELECT id, run_start, run_end, n_rises FROM {RUNS}")
def temperature_rises_sliced(spark, folder):
    return rise_rows(alerts.temperature_rises(readings(spark, folder), "12 hours", "6 hours", heavy_rows=1))


@query("rolling_averages_sliced", AVERAGES)
def rolling_averages_sliced(spark, folder):
    found = alerts.rolling_averages(readings(spark, folder), 10, 2, "6 hours", heavy_rows=1)
    return found.select("id", "firing", F.round("avg_temp", 6).alias("avg_temp"))


@query("session_windows_sliced", SESSIONS)
def session_windows_sliced(spark, folder):
    one = Measure("n", "sum", F.lit(1).cast("bigint"))
    return session_rows(sessions(readings(spark, folder), "ts", "5 hours", ["id"], "event_id", [one], heavy_rows=1))


@query("login_bursts_sliced", BURSTS)
def login_bursts_sliced(spark, folder):
    return alerts.login_bursts(logins(spark, folder), 6 * 3600, heavy_rows=1)


@query(
    "channel_counts_fine",
    f"""SELECT channel, behaviour, count(*) AS windows, CAST(sum(n) AS BIGINT) AS total, max(n) AS most FROM (
        SELECT channel, behaviour, window_end, count(*) AS n FROM (SELECT
            CASE user_id % 3 WHEN 0 THEN 'app store' WHEN 1 THEN 'wechat' ELSE 'weibo' END AS channel, behaviour,
            {ENDS.format(slide=5 * SECONDS, size=HOUR)} AS window_end FROM {BEHAVIOURS} WHERE behaviour <> 'error')
        GROUP BY ALL) GROUP BY ALL""",
)
def channel_counts_fine(spark, folder):
    """One hour every five seconds: 720 windows a row. What the windows hold, summed up by channel and behaviour."""
    counts = traffic.channel_counts(as_actions(load(spark, folder, "events")), "error")
    return counts.groupBy("channel", "behaviour").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("n").alias("total"), F.max("n").alias("most")
    )
