"""Projection, filters, flattening, branches, unions, buckets, functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import aggregates as agg_functions
from tidemark.functions import scalars, tablefuncs
from tidemark.operators import branch, buckets
from tidemark.operators.aggregates import bitmap_offset
from tidemark.operators.ranking import top_n
from tidemark.operators.sequences import by_number
from tidemark.sources.files import access_log
from tidemark.tables import as_log_lines, as_readings, as_visits, behaviours, load, readings
from workload.inputs import LOG
from workload.registry import BEHAVIOURS, READINGS, query

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


@query("map_double_and_length", "SELECT event_id, value * 2 AS doubled, length(props) AS n_chars FROM events")
def map_double_and_length(spark, folder):
    return load(spark, folder, "events").select(
        "event_id", (F.col("value") * 2).alias("doubled"), F.length("props").cast("bigint").alias("n_chars")
    )


WORDS = """(SELECT doc_id, unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN CAST([] AS VARCHAR[])
    ELSE string_split(rtrim(line, ' '), ' ') END) AS word
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents))"""


@query(
    "flat_map_words",
    f"SELECT doc_id, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS n_chars FROM {WORDS} GROUP BY doc_id",
)
def flat_map_words(spark, folder):
    words = branch.words(load(spark, folder, "documents").select("doc_id", "text"), "text")
    return words.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words"), F.sum(F.length("word")).alias("n_chars"))


@query(
    "flatten_scalar_or_list",
    f"""SELECT event_id, unnest(CASE WHEN user_id % 2 = 0 THEN [user_id, {K}] ELSE [{K}] END) AS element FROM events""",
)
def flatten_scalar_or_list(spark, folder):
    k = F.get_json_object("props", "$.k")
    pair = F.concat(F.lit("["), "user_id", F.lit(","), k, F.lit("]"))
    mixed = load(spark, folder, "events").select("event_id", F.when(F.col("user_id") % 2 == 0, pair).otherwise(k).alias("v"))
    return branch.flatten_mixed(mixed, "v", "element").select("event_id", "element")


@query(
    "first_matching_branch",
    f"""SELECT event_id, unnest(CASE event_type WHEN 'click' THEN ['click:' || {K}]
            WHEN 'signup' THEN ['order:' || {K}, 'order:' || (({K} + 1) % 100)]
            WHEN 'purchase' THEN ['pay:' || {K}, 'pay:' || (user_id % 100)] END) AS act FROM events""",
)
def first_matching_branch(spark, folder):
    visits = as_visits(load(spark, folder, "events"))
    tagged = lambda kind, ids: F.transform(ids, lambda i: F.concat(F.lit(f"{kind}:"), i))
    listed = lambda c: F.split(F.col(c), ",")
    cases = [
        (F.col("click_category_id") != "-1", tagged("click", F.array("click_category_id"))),
        (F.col("order_category_ids") != "null", tagged("order", listed("order_category_ids"))),
        (F.col("pay_category_ids") != "null", tagged("pay", listed("pay_category_ids"))),
    ]
    return branch.first_match(visits, cases, "act").select("event_id", "act")


@query("filter_behaviour", f"SELECT event_id, user_id, item_id FROM {BEHAVIOURS} WHERE behaviour = 'view'")
def filter_behaviour(spark, folder):
    return behaviours(spark, folder).where(F.col("behaviour") == "view").select("event_id", "user_id", "item_id")


@query("filter_other_than", "SELECT event_id, event_type FROM events WHERE event_type <> 'error'")
def filter_other_than(spark, folder):
    return load(spark, folder, "events").where(F.col("event_type") != "error").select("event_id", "event_type")


@query("filter_prefix", "SELECT p_partkey, p_brand FROM part WHERE starts_with(p_brand, 'Brand#1')")
def filter_prefix(spark, folder):
    return load(spark, folder, "part").where(F.col("p_brand").startswith("Brand#1")).select("p_partkey", "p_brand")


@query(
    "filter_static_resources",
    f"SELECT user_id, s, url FROM {LOG} WHERE method = 'GET' AND NOT regexp_matches(url, '\\.(css|js|png|ico)$')",
)
def filter_static_resources(spark, folder):
    log = access_log(as_log_lines(load(spark, folder, "events"))).where(F.col("method") == "GET")
    return branch.without_static(log, "url").select("user_id", F.unix_seconds("ts").alias("s"), "url")


@query(
    "select_renamed_arithmetic",
    "SELECT c_custkey AS id, c_nationkey + 1 AS next_nation, c_acctbal AS balance FROM customer",
)
def select_renamed_arithmetic(spark, folder):
    renamed = load(spark, folder, "customer").withColumnsRenamed({"c_custkey": "id", "c_acctbal": "balance"})
    return renamed.select("id", (F.col("c_nationkey") + 1).alias("next_nation"), "balance")


@query(
    "typed_records",
    """SELECT event_type <> 'error' AS is_valid, count(*) AS n,
              CAST(sum(CASE WHEN event_type <> 'error' THEN user_id ELSE 0 END) AS BIGINT) AS total FROM events GROUP BY 1""",
)
def typed_records(spark, folder):
    """Text fields become typed; rows whose fields do not parse are set apart, not dropped."""
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("?"), "user_id")).otherwise(F.col("user_id").cast("string"))
    parsed = branch.parse_or_quarantine(load(spark, folder, "events").select(text.alias("user_id")), {"user_id": "bigint"})
    return parsed.groupBy("is_valid").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("user_id", F.lit(0))).alias("total"))


@query(
    "split_high_low",
    f"SELECT event_id, id, CASE WHEN temperature > 30 THEN 'high' ELSE 'low' END AS branch FROM {READINGS}",
)
def split_high_low(spark, folder):
    high = branch.tag_branch(readings(spark, folder), F.col("temperature") > 30, "high", "low")
    return high.select("event_id", "id", "branch")


@query(
    "connect_streams",
    f"""SELECT id, temperature, 'high temp warning' AS status FROM {READINGS} WHERE temperature > 30
        UNION ALL SELECT id, NULL AS temperature, 'normal' AS status FROM {READINGS} WHERE temperature <= 30""",
)
def connect_streams(spark, folder):
    """Two branches of different shape become one stream of statuses."""
    rows = readings(spark, folder)
    high = rows.where("temperature > 30").select("id", "temperature", F.lit("high temp warning").alias("status"))
    low = rows.where("temperature <= 30").select("id", F.lit("normal").alias("status"))
    return branch.connect([high, low])


@query(
    "union_keep_duplicates",
    f"""SELECT id, temperature FROM {READINGS} WHERE temperature > 30
        UNION ALL SELECT id, temperature FROM {READINGS} WHERE temperature > 60""",
)
def union_keep_duplicates(spark, folder):
    rows = readings(spark, folder).select("id", "temperature")
    return rows.where("temperature > 30").union(rows.where("temperature > 60"))


@query(
    "sample_by_hash",
    """SELECT event_id, event_type FROM events
       WHERE CAST('0x' || left(md5('7:' || event_id), 8) AS BIGINT) < 0.4 * 4294967296""",
)
def sample_by_hash(spark, folder):
    """A sample that any run, engine and partitioning repeats: rows whose hash is under a threshold."""
    rows = load(spark, folder, "events").select("event_id", "event_type")
    return branch.hash_sample(rows, F.concat(F.lit("7:"), F.col("event_id")), 0.4)


@query("sample_with_replacement")
def sample_with_replacement(spark, folder):
    return load(spark, folder, "events").select("event_id", "event_type").sample(True, 0.4, 7)


@query("bucket_filter", "SELECT event_id, user_id FROM events WHERE user_id % 4 = 1")
def bucket_filter(spark, folder):
    return buckets.one_bucket(load(spark, folder, "events").select("event_id", "user_id"), "user_id", 4, 1)


@query(
    "bucket_sum_of_maxima",
    """SELECT round(sum(m), 2) AS sum_of_maxima
       FROM (SELECT max(l_extendedprice) AS m FROM lineitem GROUP BY l_orderkey % 16)""",
)
def bucket_sum_of_maxima(spark, folder):
    found = buckets.sum_of_maxima(load(spark, folder, "lineitem"), "l_orderkey", 16, "l_extendedprice")
    return found.select(F.round("sum_of_maxima", 2).alias("sum_of_maxima"))


@query(
    "bucket_sum_of_maxima_by_key",
    """SELECT l_returnflag, sum(m) AS sum_of_maxima
       FROM (SELECT l_returnflag, max(l_quantity) AS m FROM lineitem GROUP BY l_returnflag, l_orderkey % 16) GROUP BY 1""",
)
def bucket_sum_of_maxima_by_key(spark, folder):
    return buckets.sum_of_maxima(load(spark, folder, "lineitem"), "l_orderkey", 16, "l_quantity", ["l_returnflag"])


@query(
    "bucket_running_count",
    """SELECT event_id, user_id % 8 AS bucket, row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) AS nth
       FROM events""",
)
def bucket_running_count(spark, folder):
    events = load(spark, folder, "events").select("event_id", "user_id")
    return buckets.numbered_in_bucket(events, "user_id", 8, by_number("event_id", 1_000_000, heavy_rows=1000), ["event_id"]).select(
        "event_id", "bucket", "nth"
    )


@query("redistribute", "SELECT id, event_id FROM " + READINGS)
def redistribute(spark, folder):
    """Spread at random, then by key; the rows stay the same."""
    rows = readings(spark, folder).select("id", "event_id")
    spread = buckets.redistribute(rows, "random", spark.sparkContext.defaultParallelism)
    return buckets.redistribute(spread, "key", column="id")


@query("task_setup", "SELECT event_id, length(props) AS n_chars FROM events")
def task_setup(spark, folder):
    """A batch function with set-up once per task."""

    def open_():
        measure = str.__len__

        def work(batch: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"event_id": batch["event_id"], "n_chars": batch["props"].map(measure).astype("int64")})

        return work

    return buckets.with_setup(load(spark, folder, "events").select("event_id", "props"), open_, "event_id bigint, n_chars bigint")


@query(
    "scalar_functions",
    f"""SELECT event_id, 'Name:' || event_type AS named, length(event_type) AS n_chars,
               regexp_full_match(event_type, '[a-o]+') AS matches, abs(value - 50) AS distance,
               greatest(value, 50.0) AS at_least_50, epoch_us(ts) // 1000 AS millis,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc, (user_id * 100) // 151 AS percent,
               list_contains([1, 2, 3], user_id) AS listed
        FROM events""",
)
def scalar_functions(spark, folder):
    e = load(spark, folder, "events")
    return e.select(
        "event_id",
        scalars.prefixed("event_type").alias("named"),
        F.length("event_type").cast("bigint").alias("n_chars"),
        scalars.fully_matches("event_type", "[a-o]+").alias("matches"),
        F.abs(F.col("value") - 50).alias("distance"),
        F.greatest("value", F.lit(50.0)).alias("at_least_50"),
        F.unix_millis("ts").alias("millis"),
        scalars.utc_text("ts").alias("utc"),
        scalars.integer_percent(F.col("user_id"), F.lit(151)).alias("percent"),
        F.array_contains(F.array(*[F.lit(i).cast("bigint") for i in (1, 2, 3)]), F.col("user_id")).alias("listed"),
    )


FOLD = "list_reduce(list_transform(string_split({text}, ''), lambda ch: CAST(unicode(ch) AS HUGEINT)), lambda a, c: (a * {seed} + c) % {mod})"


@query(
    "string_hash",
    f"""SELECT DISTINCT id, CAST(((h * 23 + 2147483648) % 4294967296) - 2147483648 AS INTEGER) AS hash
        FROM (SELECT url AS id, {FOLD.format(text="url", seed=31, mod=4294967296)} AS h FROM pages)""",
)
def string_hash(spark, folder):
    pages = load(spark, folder, "pages").select(F.col("url").alias("id")).distinct()
    return pages.withColumn("hash", scalars.string_hash("id", 23))


@query(
    "string_hash_sql",
    f"""SELECT p_partkey, 'Name:' || p_name AS named,
               CAST(((h * 13 + 2147483648) % 4294967296) - 2147483648 AS INTEGER) AS hash
        FROM (SELECT p_partkey, p_name, {FOLD.format(text="p_name", seed=31, mod=4294967296)} AS h FROM part)""",
)
def string_hash_sql(spark, folder):
    """The functions as registered for SQL."""
    scalars.register(spark)
    load(spark, folder, "part").createOrReplaceTempView("part_names")
    return spark.sql("SELECT p_partkey, prefix_name(p_name) AS named, string_hash(p_name, 13) AS hash FROM part_names")


@query(
    "bitmap_offset",
    f"""SELECT DISTINCT user_id, CAST({FOLD.format(text="CAST(user_id AS VARCHAR)", seed=61, mod=536870912)} AS BIGINT)
        AS bit FROM events""",
)
def bitmap_offset_query(spark, folder):
    users = load(spark, folder, "events").select("user_id").distinct()
    return users.withColumn("bit", bitmap_offset(F.col("user_id")))


SPLIT = """(SELECT event_id, word, length(word) AS length
    FROM (SELECT event_id, unnest(string_split(user_id || '_' || event_type, '_')) AS word FROM events))"""


@query("split_rows", f"SELECT event_id, word, length FROM {SPLIT}")
def split_rows(spark, folder):
    rows = load(spark, folder, "events").select("event_id", F.concat_ws("_", "user_id", "event_type").alias("id"))
    return tablefuncs.split_rows(rows, "id", "_").select("event_id", "word", F.col("length").cast("bigint").alias("length"))


@query("split_rows_lateral", f"SELECT event_id, word, length FROM {SPLIT}")
def split_rows_lateral(spark, folder):
    """The same through the table function registered for SQL."""
    tablefuncs.register(spark, "_")
    rows = load(spark, folder, "events").select("event_id", F.concat_ws("_", "user_id", "event_type").alias("id"))
    rows.createOrReplaceTempView("split_input")
    return spark.sql(
        "SELECT event_id, word, CAST(length AS BIGINT) AS length FROM split_input, LATERAL split_words(split_input.id)"
    )


AVERAGES = """SELECT l_returnflag, CAST(sum(l_linenumber) // count(l_linenumber) AS BIGINT) AS int_avg,
    round(avg(l_extendedprice), 4) AS avg_price FROM lineitem GROUP BY l_returnflag"""


@query("average_functions", AVERAGES)
def average_functions(spark, folder):
    return load(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        agg_functions.integer_average("l_linenumber").alias("int_avg"),
        F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
    )


@query(
    "average_functions_sql",
    """SELECT user_id, CAST(trunc(sum(event_id % 7 - length(event_type)) / count(*)) AS BIGINT) AS int_avg,
              round(avg(value), 8) AS avg_temp
       FROM events GROUP BY user_id""",
)
def average_functions_sql(spark, folder):
    """The aggregate functions as registered for SQL, on values of either sign."""
    agg_functions.register(spark)
    load(spark, folder, "events").createOrReplaceTempView("average_input")
    return spark.sql(
        """SELECT user_id, int_avg, round(avg_temp, 8) AS avg_temp FROM (
               SELECT user_id, int_avg_of(sum(event_id % 7 - length(event_type)), count(*)) AS int_avg,
                      avg_of(sum(value), count(value)) AS avg_temp
               FROM average_input GROUP BY user_id)"""
    )


REMARK = """(SELECT {group}, string_agg(CASE WHEN rn <= 2 THEN city || ' ' || (n * 100 // total) || '%' END, ',' ORDER BY rn)
       || CASE WHEN max(rn) > 2 THEN ',其他 ' || (100 - sum(CASE WHEN rn <= 2 THEN n * 100 // total ELSE 0 END)) || '%'
          ELSE '' END AS city_remark, CAST(max(total) AS BIGINT) AS n
    FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY n DESC, city) AS rn,
                 CAST(sum(n) OVER (PARTITION BY {group}) AS BIGINT) AS total FROM {counts})
    GROUP BY {group})"""


@query(
    "city_remark",
    "SELECT * FROM "
    + REMARK.format(
        group="segment",
        counts="""(SELECT c_mktsegment AS segment, n_name AS city, count(*) AS n
                   FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)""",
    ),
)
def city_remark(spark, folder):
    buyers, nation = load(spark, folder, "customer"), load(spark, folder, "nation")
    counts = buyers.groupBy(F.col("c_mktsegment").alias("segment"), "c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    named = counts.join(nation, counts.c_nationkey == nation.n_nationkey).withColumnRenamed("n_name", "city")
    return agg_functions.remark_by(named, ["segment"], "city", "n")


@query(
    "table_aggregate",
    f"""SELECT id, rank, temperature FROM (SELECT id, temperature,
            row_number() OVER (PARTITION BY id ORDER BY temperature DESC, event_id) AS rank FROM {READINGS}) WHERE rank <= 2""",
)
def table_aggregate(spark, folder):
    """An aggregate returning rows per group: the two highest readings."""
    rows = as_readings(load(spark, folder, "events"))
    return top_n(rows, ["id"], [F.desc("temperature"), F.asc("event_id")], 2).select(
        "id", F.col("rank").cast("bigint").alias("rank"), "temperature"
    )
