"""Joins, aggregations, rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.tablefuncs import split_rows
from tidemark.operators import aggregates, ranking
from tidemark.operators.branch import words
from tidemark.operators.joins import window_join
from tidemark.operators.sequences import Measure, by_number, by_time, running
from tidemark.operators.windows import epoch
from tidemark.plans import alerts, popularity, traffic
from tidemark.session import scratch_dir
from tidemark.sources.files import access_log
from tidemark.tables import as_log_lines, behaviours, cities, load, products, readings, sales, side, visits
from workload.inputs import LOG
from workload.registry import BEHAVIOURS, HOUR, READINGS, query
from workload.shaping import REMARK, WORDS

SALES = """(SELECT p_partkey AS product_id, p_name AS product_name, n_nationkey AS city_id, n_name AS city_name, r_name AS area
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""


@query(
    "star_join",
    """SELECT n_name AS city_name, r_name AS area, p_brand, count(*) AS n, round(sum(l_quantity), 2) AS quantity
       FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       WHERE l_partkey > 100 GROUP BY ALL""",
)
def star_join(spark, folder):
    """Fact and dimensions with a range predicate; Spark broadcasts a dimension if its size allows."""
    lines = load(spark, folder, "lineitem").where("l_partkey > 100")
    suppliers, parts = load(spark, folder, "supplier"), load(spark, folder, "part")
    counts = lines.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
    joined = (
        counts.join(parts, counts.l_partkey == parts.p_partkey)
        .join(suppliers, counts.l_suppkey == suppliers.s_suppkey)
        .join(cities(spark, folder), F.col("s_nationkey") == F.col("city_id"))
    )
    return joined.groupBy("city_name", "area", "p_brand").agg(
        F.sum("n").alias("n"), F.round(F.sum("quantity"), 2).alias("quantity")
    )


SIDE = "(SELECT user_id AS tx_id, event_id AS {p}_id, epoch_us(ts) AS {p}_us FROM events WHERE event_type = '{t}')"
PAYS, RECEIPTS = SIDE.format(p="pay", t="click"), SIDE.format(p="receipt", t="view")


def _sides(spark, folder):
    events = load(spark, folder, "events")
    return side(events, "click", "pay"), side(events, "view", "receipt")


@query(
    "window_pairs",
    f"""SELECT tx_id, pay_id, receipt_id, (pay_us // {6 * HOUR} + 1) * 21600 AS window_end
        FROM {PAYS} JOIN {RECEIPTS} USING (tx_id) WHERE pay_us // {6 * HOUR} = receipt_us // {6 * HOUR}""",
)
def window_pairs(spark, folder):
    pairs = window_join(*_sides(spark, folder), ["tx_id"], "pay_ts", "receipt_ts", "6 hours")
    return pairs.select("tx_id", "pay_id", "receipt_id", epoch("window_end").alias("window_end"))


@query(
    "interval_pairs",
    f"""SELECT tx_id, pay_id, receipt_id FROM {PAYS} JOIN {RECEIPTS} USING (tx_id)
        WHERE receipt_us BETWEEN pay_us - {3 * HOUR} AND pay_us + {5 * HOUR}""",
)
def interval_pairs(spark, folder):
    pairs = alerts.matched_payments(*_sides(spark, folder), "3 hours", "5 hours")
    return pairs.select("tx_id", "pay_id", "receipt_id")


RECONCILED = f"""SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, coalesce(pay_id, -1) AS pay_id,
    coalesce(receipt_id, -1) AS receipt_id, CASE WHEN r.tx_id IS NULL THEN 'unmatched_pay'
    WHEN p.tx_id IS NULL THEN 'unmatched_receipt' ELSE 'matched' END AS branch
    FROM {PAYS} p FULL JOIN {RECEIPTS} r
    ON p.tx_id = r.tx_id AND receipt_us BETWEEN pay_us - {3 * HOUR} AND pay_us + {5 * HOUR}"""


def reconciled_rows(found):
    return found.select(
        "tx_id",
        F.coalesce("pay_id", F.lit(-1)).alias("pay_id"),
        F.coalesce("receipt_id", F.lit(-1)).alias("receipt_id"),
        "branch",
    )


@query("reconcile_payments", RECONCILED)
def reconcile_payments(spark, folder):
    return reconciled_rows(alerts.reconciled_payments(*_sides(spark, folder), "3 hours", "5 hours"))


SPARSE = "(SELECT nullif(tx_id % 40, 7) AS tx_id, * EXCLUDE (tx_id) FROM {})"


@query(
    "reconcile_sparse_keys",
    f"""SELECT coalesce(p.tx_id, r.tx_id, -1) AS tx_id, coalesce(pay_id, -1) AS pay_id,
    coalesce(receipt_id, -1) AS receipt_id, CASE WHEN receipt_id IS NULL THEN 'unmatched_pay'
    WHEN pay_id IS NULL THEN 'unmatched_receipt' ELSE 'matched' END AS branch
    FROM {SPARSE.format(PAYS)} p FULL JOIN {SPARSE.format(RECEIPTS)} r
    ON p.tx_id = r.tx_id AND receipt_us BETWEEN pay_us - 60000000 AND pay_us + 300000000""",
)
def reconcile_sparse_keys(spark, folder):
    """Some payments and receipts have no transaction: they match nothing and are shown as unmatched."""
    pays, receipts = (
        rows.withColumn("tx_id", F.nullif(F.col("tx_id") % 40, F.lit(7))) for rows in _sides(spark, folder)
    )
    return reconciled_rows(alerts.reconciled_payments(pays, receipts, "1 minute", "5 minutes")).fillna(-1, "tx_id")


@query(
    "lateral_split_join",
    """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word""",
)
def lateral_split_join(spark, folder):
    return split_rows(load(spark, folder, "part"), "p_name", " ").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


WORD_COUNT = f"SELECT word, count(*) AS n FROM {WORDS} GROUP BY word"


@query("word_count", WORD_COUNT)
def word_count(spark, folder):
    return traffic.word_count(load(spark, folder, "documents"), "text")


@query(
    "word_count_pairs",
    f"SELECT lower(word) AS word, CAST(sum(1) AS BIGINT) AS total FROM {WORDS} GROUP BY lower(word)",
)
def word_count_pairs(spark, folder):
    """Pairs (word, 1) summed by key: combined in every task before the shuffle."""
    pairs = words(load(spark, folder, "documents").select("text"), "text").select(F.lower("word").alias("word"))
    return aggregates.sum_by(pairs, ["word"], F.lit(1).cast("bigint"))


@query(
    "word_count_maps",
    f"""SELECT CAST(part AS BIGINT) AS part, count(*) AS n_words, CAST(sum(n) AS BIGINT) AS total FROM (
            SELECT CAST('0x' || left(md5(word), 8) AS BIGINT) % greatest((count(*) OVER () + 999) // 1000, 1) AS part, n
            FROM (SELECT word, count(*) AS n FROM {WORDS} GROUP BY ALL)) GROUP BY part""",
)
def word_count_maps(spark, folder):
    """Counts gathered into maps by parts of the words' hashes: as many as keep a map near a thousand words."""
    counts = traffic.word_count(load(spark, folder, "documents"), "text")
    path = scratch_dir(spark, "counts")
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    parts = max(1, -(-counts.count() // 1000))
    number = F.conv(F.substring(F.md5(F.col("word").cast("binary")), 1, 8), 16, 10).cast("bigint")
    maps = aggregates.as_map(counts, "word", "n", F.pmod(number, F.lit(parts)).cast("bigint"))
    total = F.aggregate(F.map_values("counts"), F.lit(0).cast("bigint"), lambda acc, n: acc + n)
    return maps.select("part", F.size("counts").cast("bigint").alias("n_words"), total.alias("total"))


@query("global_sum", "SELECT CAST(sum(l_quantity) AS BIGINT) AS quantity, count(*) AS n FROM lineitem")
def global_sum(spark, folder):
    return load(spark, folder, "lineitem").agg(
        F.sum("l_quantity").cast("bigint").alias("quantity"), F.count(F.lit(1)).alias("n")
    )


@query("count_by_two_keys", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def count_by_two_keys(spark, folder):
    return aggregates.count_by(load(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"])


@query(
    "count_and_average",
    f"SELECT id, count(*) AS n, round(avg(temperature), 8) AS avg_temp FROM {READINGS} GROUP BY id",
)
def count_and_average(spark, folder):
    return readings(spark, folder).groupBy("id").agg(
        F.count("id").alias("n"), F.round(F.avg("temperature"), 8).alias("avg_temp")
    )


@query("global_average", "SELECT round(avg(c_acctbal), 4) AS avg_balance FROM customer")
def global_average(spark, folder):
    load(spark, folder, "customer").createOrReplaceTempView("balances")
    return spark.sql("SELECT round(avg(c_acctbal), 4) AS avg_balance FROM balances")


@query(
    "max_row_by_key",
    f"""SELECT id, event_id, temperature FROM (SELECT *,
            row_number() OVER (PARTITION BY id ORDER BY temperature DESC, event_id) AS rn FROM {READINGS}) WHERE rn = 1""",
)
def max_row_by_key(spark, folder):
    rows = readings(spark, folder).select("id", "event_id", "temperature")
    return aggregates.max_row(rows, ["id"], "temperature", ["event_id"])


MAX_ROWS = f"""SELECT id, event_id, arg_max(event_id, (temperature, -event_id)) OVER so_far AS max_event_id,
               max(temperature) OVER so_far AS max_temperature FROM {READINGS}
        WINDOW so_far AS (PARTITION BY id ORDER BY event_id ROWS UNBOUNDED PRECEDING)"""


def _max_rows(spark, folder, slices):
    rows = readings(spark, folder).select("id", "event_id", "temperature", "ts")
    best = aggregates.running_max_row(rows, ["id"], "temperature", ["event_id"], slices)
    return best.select("id", "event_id", "max_event_id", "max_temperature")


@query("running_max_row", MAX_ROWS)
def running_max_row(spark, folder):
    return _max_rows(spark, folder, by_number("event_id", 1_000_000))


@query("running_max_row_sliced", MAX_ROWS)
def running_max_row_sliced(spark, folder):
    """Every key taken as a heavy one."""
    return _max_rows(spark, folder, by_number("event_id", 2500, 1))


@query(
    "rolling_reduce",
    f"""SELECT id, us // 1000000 AS s, event_id, max(temperature) OVER (PARTITION BY id ORDER BY us, event_id
            ROWS UNBOUNDED PRECEDING) AS max_temperature FROM {READINGS}""",
)
def rolling_reduce(spark, folder):
    """Newest time with the highest temperature so far."""
    best = running(
        readings(spark, folder), ["id"], ["ts", "event_id"], by_time("ts"),
        [Measure("max_temperature", "max", F.col("temperature"))],
    )
    return best.select("id", epoch("ts").alias("s"), "event_id", "max_temperature")


@query(
    "rolling_count",
    """SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts), event_id
           ROWS UNBOUNDED PRECEDING) AS n FROM events""",
)
def rolling_count(spark, folder):
    """Running total of every word of a stream; with five words in all, every key is hot."""
    rows = load(spark, folder, "events").select("event_id", "event_type", "ts")
    one = Measure("n", "sum", F.lit(1).cast("bigint"))
    slices = by_time("ts", heavy_rows=1000)
    return running(rows, ["event_type"], ["ts", "event_id"], slices, [one]).select("event_id", "event_type", "n")


@query(
    "unique_visitors",
    f"""SELECT (us // {HOUR} + 1) * 3600 AS window_end, count(DISTINCT user_id) AS uv
        FROM {BEHAVIOURS} WHERE behaviour = 'view' GROUP BY 1""",
)
def unique_visitors(spark, folder):
    found = traffic.unique_visitors(behaviours(spark, folder), "view")
    return found.select(epoch("window_end").alias("window_end"), "uv")


# For digits only, the hash of a user id is the same as in workload.shaping.bitmap_offset.
BIT = """CAST(list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda ch: CAST(unicode(ch) AS HUGEINT)),
    lambda a, c: (a * 61 + c) % 536870912) AS BIGINT)"""


@query(
    "unique_visitors_bitmap",
    f"""SELECT (us // {HOUR} + 1) * 3600 AS window_end, count(DISTINCT {BIT}) AS uv
        FROM {BEHAVIOURS} WHERE behaviour = 'view' GROUP BY 1""",
)
def unique_visitors_bitmap(spark, folder):
    found = traffic.unique_visitors_bitmap(behaviours(spark, folder), "view")
    return found.select(epoch("window_end").alias("window_end"), "uv")


@query(
    "unique_visitors_bitmap_store",
    f"SELECT (us // {24 * HOUR} + 1) * 86400 AS window_end, count(DISTINCT {BIT}) AS uv FROM {BEHAVIOURS} GROUP BY 1",
)
def unique_visitors_bitmap_store(spark, folder):
    """Daily users from bit-map pieces, as kept between runs."""
    end = epoch(F.window("ts", "1 day")["end"]).alias("window_end")
    windowed = behaviours(spark, folder).select(end, "user_id")
    store = aggregates.bitmap_store(windowed, "window_end", "user_id")
    return aggregates.bitmap_store_count(store, "window_end")


@query(
    "rank_with_ties",
    """SELECT area, n_items, s_name, CAST(rank AS INTEGER) AS rank FROM (SELECT *,
            rank() OVER (PARTITION BY area ORDER BY n_items DESC) AS rank
        FROM (SELECT r_name AS area, s_name, count(*) // 20 AS n_items FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)) WHERE rank < 3""",
)
def rank_with_ties(spark, folder):
    """The counts by area are written once: ranking reads them twice."""
    suppliers, lines = load(spark, folder, "supplier"), load(spark, folder, "lineitem")
    counts = aggregates.count_by(lines, ["l_suppkey"])
    named = counts.join(suppliers, counts.l_suppkey == suppliers.s_suppkey).join(
        cities(spark, folder), F.col("s_nationkey") == F.col("city_id")
    )
    items = F.floor(F.col("n") / 20).cast("bigint").alias("n_items")
    path = scratch_dir(spark, "items")
    named.select("area", items, "s_name").write.parquet(path)
    return ranking.top_ranked(spark.read.parquet(path), ["area"], "n_items", 2)


HOT = """SELECT window_end, {key}, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY n DESC, {key}) AS rank
    FROM (SELECT window_end, {key}, count(*) AS n
          FROM (SELECT unnest(generate_series(s // {slide} * {slide} + {slide}, s // {slide} * {slide} + {size}, {slide}))
                    AS window_end, {key} FROM {rows}) GROUP BY ALL)) WHERE rank <= {top}"""

HOT_ITEMS = HOT.format(
    key="item_id", slide=300, size=3600, top=5,
    rows=f"(SELECT item_id, us // 1000000 AS s FROM {BEHAVIOURS} WHERE behaviour = 'view')",
)


def ranked_rows(found, key):
    return found.select(epoch("window_end").alias("window_end"), key, "n", F.col("rank").cast("bigint").alias("rank"))


@query("hot_items", HOT_ITEMS)
def hot_items(spark, folder):
    return ranked_rows(popularity.hot_items(behaviours(spark, folder), "view"), "item_id")


@query(
    "hot_items_sql",
    HOT_ITEMS,
)
def hot_items_sql(spark, folder):
    """The same in Spark SQL over a view."""
    behaviours(spark, folder).createOrReplaceTempView("behaviours")
    return spark.sql(
        """WITH counts AS (
             SELECT window(ts, '1 hour', '5 minutes').end AS ended, item_id, count(*) AS n
             FROM behaviours WHERE behaviour = 'view' GROUP BY window(ts, '1 hour', '5 minutes'), item_id),
           ranked AS (
             SELECT *, row_number() OVER (PARTITION BY ended ORDER BY n DESC, item_id) AS rank FROM counts)
           SELECT unix_seconds(ended) AS window_end, item_id, n, CAST(rank AS BIGINT) AS rank FROM ranked WHERE rank <= 5"""
    )


HOT_PAGES = HOT.format(
    key="url", slide=60, size=600, top=3,
    rows=f"(SELECT url, s FROM {LOG} WHERE method = 'GET' AND NOT regexp_matches(url, '\\.(css|js|png|ico)$'))",
)


@query("hot_pages", HOT_PAGES)
def hot_pages(spark, folder):
    log = access_log(as_log_lines(load(spark, folder, "events")))
    return ranked_rows(popularity.hot_pages(log, slide="1 minute"), "url")


FINE_PAGES = HOT.format(
    key="url", slide=5, size=600, top=3,
    rows=f"(SELECT url, s FROM {LOG} WHERE method = 'GET' AND NOT regexp_matches(url, '\\.(css|js|png|ico)$'))",
)


@query("hot_pages_fine", f"SELECT url, count(*) AS windows, CAST(sum(n) AS BIGINT) AS total FROM ({FINE_PAGES}) GROUP BY url")
def hot_pages_fine(spark, folder):
    """Ten minutes every five seconds; how often each page is among the first three, and with how many views."""
    top = popularity.hot_pages(access_log(as_log_lines(load(spark, folder, "events"))), slide="5 seconds")
    return top.groupBy("url").agg(F.count(F.lit(1)).alias("windows"), F.sum("n").alias("total"))


@query(
    "top_brands_per_region",
    """SELECT area, p_brand, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY n DESC, p_brand) AS rank
        FROM (SELECT r_name AS area, p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
              JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)) WHERE rank <= 3""",
)
def top_brands_per_region(spark, folder):
    parts, suppliers = load(spark, folder, "part"), load(spark, folder, "supplier")
    counts = aggregates.count_by(load(spark, folder, "lineitem"), ["l_partkey", "l_suppkey"])
    joined = (
        counts.join(parts, counts.l_partkey == parts.p_partkey)
        .join(suppliers, counts.l_suppkey == suppliers.s_suppkey)
        .join(cities(spark, folder), F.col("s_nationkey") == F.col("city_id"))
    )
    totals = joined.groupBy("area", "p_brand").agg(F.sum("n").alias("n"))
    top = ranking.top_n(totals, ["area"], [F.desc("n"), F.asc("p_brand")], 3)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "top_kinds_per_user",
    f"""SELECT user_id, behaviour, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, behaviour)
            AS rank FROM (SELECT user_id, behaviour, count(*) AS n FROM {BEHAVIOURS} GROUP BY ALL)) WHERE rank <= 3""",
)
def top_kinds_per_user(spark, folder):
    top = popularity.top_per_group(behaviours(spark, folder), "user_id", "behaviour", 3)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
ACTIVITY = f"""(SELECT CAST(category_id AS VARCHAR) AS category_id, count(*) FILTER (kind = 'click') AS clicks,
        count(*) FILTER (kind = 'order') AS orders, count(*) FILTER (kind = 'pay') AS pays
    FROM (SELECT 'click' AS kind, {K} AS category_id FROM events WHERE event_type = 'click'
          UNION ALL SELECT 'order', unnest([{K}, ({K} + 1) % 100]) FROM events WHERE event_type = 'signup'
          UNION ALL SELECT 'pay', unnest([{K}, user_id % 100]) FROM events WHERE event_type = 'purchase') GROUP BY 1)"""
HOT_CATEGORIES = f"(SELECT * FROM {ACTIVITY} ORDER BY clicks DESC, orders DESC, pays DESC, category_id LIMIT 10)"


@query("category_activity", f"SELECT * FROM {ACTIVITY}")
def category_activity(spark, folder):
    return popularity.category_activity(visits(spark, folder))


@query("hot_categories", f"SELECT * FROM {HOT_CATEGORIES}")
def hot_categories(spark, folder):
    return popularity.hot_categories(visits(spark, folder))


@query(
    "category_sessions",
    f"""SELECT category_id, session_id, n, rank FROM (SELECT *,
            row_number() OVER (PARTITION BY category_id ORDER BY n DESC, session_id) AS rank
        FROM (SELECT CAST({K} AS VARCHAR) AS category_id, user_id AS session_id, count(*) AS n FROM events
              WHERE event_type = 'click' AND CAST({K} AS VARCHAR) IN (SELECT category_id FROM {HOT_CATEGORIES}) GROUP BY ALL))
        WHERE rank <= 10""",
)
def category_sessions(spark, folder):
    found = popularity.category_sessions(visits(spark, folder))
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "hot_products_by_region",
    """SELECT area, product_name, n, city_remark, CAST(rank AS INTEGER) AS rank FROM (SELECT *,
           rank() OVER (PARTITION BY area ORDER BY n DESC) AS rank FROM """
    + REMARK.format(
        group="area, product_name",
        counts=f"(SELECT area, product_name, city_name AS city, count(*) AS n FROM {SALES} GROUP BY ALL)",
    )
    + ") WHERE rank < 3",
)
def hot_products_by_region(spark, folder):
    return popularity.hot_products_by_region(sales(spark, folder), products(spark, folder), cities(spark, folder))
