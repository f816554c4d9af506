"""Known results on small inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests import data
from tests.conftest import rows
from tidemark.functions import aggregates as agg_functions
from tidemark.functions import scalars, tablefuncs
from tidemark.operators import aggregates, branch, buckets, lateness
from tidemark.operators.sequences import Measure, by_number
from tidemark.operators.windows import epoch, sliding, tumbling
from tidemark.plans import alerts, popularity, traffic
from tidemark.plans.sync import synchronised
from tidemark.sources import external, files


def with_ids(df, *, out="event_id"):
    """Numbers rows in file order (one small file, so ids follow the lines)."""
    return df.withColumn(out, F.monotonically_increasing_id())


@pytest.fixture
def sensor(spark, folder):
    df = files.delimited(spark, folder("sensor.csv", data.SENSOR), files.SCHEMAS["sensor"])
    return with_ids(files.with_event_time(df))


@pytest.fixture
def behaviours(spark, folder):
    df = files.delimited(spark, folder("behavior.csv", data.USER_BEHAVIOR), files.SCHEMAS["user_behavior"])
    return with_ids(files.with_event_time(df)).withColumnRenamed("behavior", "behaviour")


@pytest.fixture
def logins(spark, folder):
    df = files.delimited(spark, folder("logins.csv", data.LOGINS), files.SCHEMAS["login"])
    return with_ids(files.with_event_time(df)).withColumnRenamed("login_status", "status")


@pytest.fixture
def orders(spark, folder):
    df = files.delimited(spark, folder("orders.csv", data.ORDERS), files.SCHEMAS["order"])
    return with_ids(files.with_event_time(df))


@pytest.fixture
def receipts(spark, folder):
    df = files.delimited(spark, folder("receipts.csv", data.RECEIPTS), files.SCHEMAS["receipt"])
    return files.with_event_time(df, out="receipt_ts").select("tx_id", "pay_channel", "receipt_ts")


@pytest.fixture
def pays(orders):
    return orders.where("tx_id IS NOT NULL").select("tx_id", "order_id", F.col("ts").alias("pay_ts"))


def test_word_counts(spark, folder):
    path = folder("words/words.txt", "Hello Scala\nHello Spark\n")
    counts = traffic.word_count(files.text_lines(spark, path), "value")
    assert rows(counts) == [("Hello", 2), ("Scala", 1), ("Spark", 1)]
    folder("two/1.txt", "hello scala\nhello spark\n")
    both = folder("two/2.txt", "hello scala\nhello spark\n")
    lines = files.text_lines(spark, both.rsplit("/", 1)[0])
    assert rows(traffic.word_count(lines, "value")) == [("hello", 4), ("scala", 2), ("spark", 2)]
    pairs = branch.words(lines, "value").select("word")
    assert rows(aggregates.sum_by(pairs, ["word"], F.lit(1))) == [("hello", 4), ("scala", 2), ("spark", 2)]
    maps = aggregates.as_map(traffic.word_count(lines, "value"), "word", "n", F.lit(0))
    assert maps.first()["counts"] == {"hello": 4, "scala": 2, "spark": 2}


def test_whole_files(spark, folder):
    folder("two/1.txt", "hello scala\nhello spark\n")
    path = folder("two/2.txt", "x")
    found = files.whole_files(spark, path.rsplit("/", 1)[0])
    assert sorted(r["value"] for r in found.collect()) == ["hello scala\nhello spark\n", "x"]


def test_java_split(spark):
    df = spark.createDataFrame([("a,b,,",), ("",), (",,",), (",a",)], "t string")
    parts = [r[0] for r in df.select(scalars.java_split("t", ",")).collect()]
    assert parts == [["a", "b"], [""], [], ["", "a"]]
    assert spark.range(1).select(scalars.java_split(F.lit("a||b||||"), "||")).first()[0] == ["a", "b"]


def test_integer_average(spark, folder):
    users = files.json_lines(spark, folder("users.json", data.USERS))
    assert users.agg(agg_functions.integer_average("age")).first()[0] == 30
    agg_functions.register(spark)
    users.createOrReplaceTempView("users")
    averages = "int_avg_of(sum(age), count(age)), avg_of(sum(CAST(age AS DOUBLE)), count(age))"
    assert spark.sql(f"SELECT {averages} FROM users").first() == (30, 30.0)
    assert spark.sql(f"SELECT {averages} FROM users WHERE age > 99").first() == (None, None)
    assert spark.sql("SELECT int_avg_of(sum(n), count(n)) FROM VALUES (-3), (-4) AS t(n)").first()[0] == -3
    assert users.where("age > 99").agg(agg_functions.integer_average("age")).first()[0] is None


def test_buckets(spark):
    numbers = spark.createDataFrame([(0, 1), (0, 2), (1, 3), (1, 4)], "part bigint, n bigint")
    assert buckets.sum_of_maxima(numbers, "part", 2, "n").first()[0] == 6
    pairs = spark.createDataFrame(
        [(0, "a", 1), (0, "a", 2), (0, "b", 3), (1, "b", 4), (1, "b", 5), (1, "a", 6)], "part bigint, k string, n bigint"
    )
    assert rows(buckets.sum_of_maxima(pairs, "part", 2, "n", ["k"])) == [("a", 8), ("b", 8)]
    assert rows(buckets.one_bucket(numbers, "part", 2, 1)) == [(1, 3), (1, 4)]


def test_count_and_average(sensor):
    found = sensor.groupBy("id").agg(F.count("id"), F.round(F.avg("temperature"), 6))
    assert rows(found) == [
        ("sensor_1", 3, 27.98), ("sensor_10", 2, 32.341531), ("sensor_5", 1, 36.8), ("sensor_7", 3, 29.134282),
    ]


def test_max_rows(sensor):
    best = aggregates.max_row(sensor.drop("ts"), ["id"], "temperature", ["event_id"])
    assert rows(best, "id", "time_stamp", "temperature") == [
        ("sensor_1", 1606879888, 37.34), ("sensor_10", 1606879668, 37.3415313),
        ("sensor_5", 1606879603, 36.8), ("sensor_7", 1606879606, 33.1342817),
    ]
    so_far = aggregates.running_max_row(
        sensor.drop("ts"), ["id"], "temperature", ["event_id"], by_number("event_id", 2)
    ).where("id = 'sensor_7'")
    assert rows(so_far, "time_stamp", "max_temperature") == [
        (1606879606, 33.1342817), (1606879609, 33.1342817), (1606879611, 33.1342817),
    ]


def test_prefix_and_branches(sensor):
    assert sensor.where(F.col("id").startswith("sensor_1")).count() == 5
    assert rows(alerts.temperature_branches(sensor).groupBy("branch").count()) == [("high", 6), ("low", 3)]


def test_jumps(sensor):
    found = alerts.temperature_jumps(sensor, 10.0)
    assert rows(found, "id", "before", "after") == [
        ("sensor_1", 37.34, 10.8), ("sensor_10", 37.3415313, 27.3415313), ("sensor_7", 33.1342817, 23.1342817),
    ]


def test_counted_windows(sensor):
    found = alerts.rolling_averages(sensor, 10, 2)
    assert rows(found.select("id", "firing", F.round("avg_temp", 7))) == [
        ("sensor_1", 1, 36.57), ("sensor_10", 1, 32.3415313), ("sensor_7", 1, 28.1342817),
    ]


def test_tumbling_minimum(sensor):
    """End of each window and the whole coldest row in it."""
    coldest = F.min_by(F.struct("temperature", "time_stamp"), F.struct("temperature", "event_id")).alias("row")
    found = tumbling(sensor, "ts", "15 seconds", ["id"], [coldest])
    assert rows(found.select("id", epoch("window_end"), "row.temperature", "row.time_stamp")) == [
        ("sensor_1", 1606879605, 35.8, 1606879600),
        ("sensor_1", 1606879890, 37.34, 1606879888),
        ("sensor_1", 1606880010, 10.8, 1606879999),
        ("sensor_10", 1606879680, 37.3415313, 1606879668),
        ("sensor_10", 1606879785, 27.3415313, 1606879777),
        ("sensor_5", 1606879605, 36.8, 1606879603),
        ("sensor_7", 1606879620, 23.1342817, 1606879609),
    ]


def test_late_rows(spark, folder):
    df = files.delimited(spark, folder("out.csv", data.SENSOR_DISORDERED), files.SCHEMAS["sensor"])
    arrived = with_ids(files.with_event_time(df), out="arrival")
    for per_slice in (1, 2, 100):
        tagged = lateness.tag_late(arrived, "arrival", "ts", 15, 15, 2, 60, arrivals_per_slice=per_slice)
        assert [r["is_late"] for r in tagged.orderBy("arrival").collect()] == [False] * 4 + [True] * 5


def test_string_hash(sensor, spark):
    found = sensor.select("id", scalars.string_hash("id", 23)).distinct()
    expected = [
        ("sensor_1", -1036124876), ("sensor_10", -2055098980), ("sensor_5", -1036124784), ("sensor_7", -1036124738),
    ]
    assert rows(found) == expected
    scalars.register(spark)
    sensor.createOrReplaceTempView("sensor_ids")
    assert rows(spark.sql("SELECT DISTINCT id, string_hash(id, 23) FROM sensor_ids")) == expected


def test_string_hash_beyond_basic_plane(spark):
    def expected(text):
        h, raw = 0, text.encode("utf-16-be")
        for i in range(0, len(raw), 2):
            h = (h * 31 + int.from_bytes(raw[i : i + 2], "big")) % 2**32
        return h - 2**32 if h >= 2**31 else h

    texts = ["", "a", "a😀é", "商品_1", "x" * 300]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(scalars.string_hash("t", 1)).collect()] == [expected(t) for t in texts]
    scalars.register(spark)
    assert [r[0] for r in df.selectExpr("string_hash(t, 1)").collect()] == [expected(t) for t in texts]


def test_split_rows(spark, sensor):
    ids = sensor.where("id = 'sensor_10'").select("id").distinct()
    assert rows(tablefuncs.split_rows(ids, "id", "_"), "word", "length") == [("10", 2), ("sensor", 6)]
    tablefuncs.register(spark, "_")
    ids.createOrReplaceTempView("ids")
    assert rows(spark.sql("SELECT word, length FROM ids, LATERAL split_words(ids.id)")) == [("10", 2), ("sensor", 6)]
    odd = "VALUES (''), ('_'), ('a__b_'), (NULL) AS t(s)"
    split = spark.sql(f"SELECT s, word FROM {odd}, LATERAL split_words(t.s)")
    assert rows(split) == [("", ""), ("a__b_", ""), ("a__b_", "a"), ("a__b_", "b")]


def test_sliding_counts_and_hot_items(behaviours):
    counts = sliding(behaviours, "ts", "1 hour", "5 minutes", ["item_id"], [Measure("n", "sum", F.lit(1))])
    assert counts.count() == 63
    assert counts.select("window_end").distinct().count() == 24
    top = popularity.hot_items(behaviours).select(epoch("window_end").alias("end"), "rank", "item_id", "n")
    at = lambda end: rows(top.where(F.col("end") == end).drop("end"))
    assert at(1511658300) == [(1, 1715, 2), (2, 2244074, 2), (3, 3611281, 1)]
    assert at(1511658900) == [(1, 1715, 3), (2, 2244074, 3), (3, 3611281, 2), (4, 1256540, 1)]
    assert at(1511665200) == [(1, 1715, 1)]


def test_views_and_visitors(behaviours):
    for found in (
        traffic.page_views(behaviours),
        traffic.page_views_salted(behaviours),
        traffic.unique_visitors(behaviours),
        traffic.unique_visitors_bitmap(behaviours),
    ):
        end, n = found.columns
        assert rows(found.select(epoch(end), n)) == [(1511661600, 9), (1511665200, 1)]


def test_login_failures(logins):
    seconds = lambda df: rows(df.select("user_id", epoch("first_ts"), epoch("last_ts")))
    expected = [(1035, 1558430842, 1558430843), (1035, 1558430843, 1558430844)]
    assert seconds(alerts.login_failures(logins)) == expected
    assert seconds(alerts.login_failures(logins, inclusive=False)) == expected
    assert seconds(alerts.login_failures(logins, 3, inclusive=False)) == []
    assert seconds(alerts.login_failures(logins, 3)) == [(1035, 1558430842, 1558430844)]
    assert rows(alerts.login_bursts(logins)) == [(1035, 1558430842, 1558430844, 3)]


def test_payment_timeouts(orders):
    found = alerts.payment_timeouts(orders)
    assert found.where("result = 'payed'").count() == 37
    late = rows(found.where("result <> 'payed'"), "order_id", "result")
    assert late == [(34756, "timeout:1558431813000"), (34767, "timeout:1558431849000")]


def test_matched_payments(pays, receipts):
    pairs = alerts.matched_payments(pays, receipts)
    gap = F.unix_seconds("receipt_ts") - F.unix_seconds("pay_ts")
    assert rows(pairs.select("tx_id", gap)) == [
        ("3243hr9h9", -3), ("329d09f9f", 0), ("3hu3k2432", 3), ("sd76f87d6", 3),
    ]
    assert pays.join(receipts, "tx_id").count() == 37


def test_reconciled_payments(pays, receipts):
    branches = alerts.reconciled_payments(pays, receipts).groupBy("branch").count()
    assert rows(branches) == [("matched", 4), ("unmatched_pay", 35), ("unmatched_receipt", 36)]


def test_declared_tables(spark, folder):
    external.declare_table(spark, "city_golden", folder("city.txt", data.CITIES), files.SCHEMAS["city_info"])
    found = spark.sql("SELECT area, count(*) FROM city_golden GROUP BY area")
    assert {tuple(r) for r in found.collect()} == {
        ("华东", 7), ("华北", 5), ("华南", 4), ("西南", 3), ("东北", 3), ("华中", 2), ("西北", 2),
    }
    external.declare_table(spark, "product_golden", folder("product.txt", data.PRODUCTS), files.SCHEMAS["product_info"])
    kinds = spark.sql("SELECT extend_info, count(*) FROM product_golden GROUP BY 1")
    assert {tuple(r) for r in kinds.collect()} == {("own", 3), ("partner", 2)}


def test_city_remark(spark):
    counts = spark.createDataFrame(
        [("k", "A", 5), ("k", "B", 3), ("k", "C", 2), ("k", "D", 1), ("j", "X", 2), ("j", "Y", 1)],
        "k string, city string, n bigint",
    )
    expected = [("j", 3, "X 66%,Y 33%"), ("k", 11, "A 45%,B 27%,其他 28%")]
    assert rows(agg_functions.remark_by(counts, ["k"], "city", "n")) == expected
    agg_functions.register(spark)
    counts.select("k", F.explode(F.array_repeat("city", F.col("n").cast("int"))).alias("city")).createOrReplaceTempView("r")
    by_city = "(SELECT k, city, count(*) AS n FROM r GROUP BY k, city)"
    remark = "city_remark_of(collect_list(struct(n, city)), sum(n))"
    assert rows(spark.sql(f"SELECT k, sum(n), {remark} FROM {by_city} GROUP BY k")) == expected


def test_hot_products(spark):
    """Products of equal sales share a rank; rank 1 and 2 are shown."""
    sales = spark.createDataFrame([(p, c) for p, c, n in [(1, 1, 3), (1, 2, 1), (2, 1, 4), (3, 2, 1)] for _ in range(n)],
                                  "product_id bigint, city_id bigint")
    products = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "p3")], "product_id bigint, product_name string")
    cities = spark.createDataFrame([(1, "c1", "a"), (2, "c2", "a")], "city_id bigint, city_name string, area string")
    assert rows(popularity.hot_products_by_region(sales, products, cities), "product_name", "n", "rank", "city_remark") == [
        ("p1", 4, 1, "c1 75%,c2 25%"), ("p2", 4, 1, "c1 100%"),
    ]


def test_access_log_and_static_files(spark):
    line = "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET "
    urls = ["/a.css", "/a.css.map", "/b.js", "/c.png", "/d.ico", "/presentations/x.html"]
    log = files.access_log(spark.createDataFrame([(line + u,) for u in urls], "value string"))
    assert log.select(epoch("ts")).first()[0] == 1431857103
    assert [r["url"] for r in branch.without_static(log, "url").collect()] == ["/a.css.map", "/presentations/x.html"]


def test_flatten_and_first_match(spark):
    mixed = spark.createDataFrame([("[1,2]",), ("3",), ("[4,5]",)], "v string")
    assert [r["e"] for r in branch.flatten_mixed(mixed, "v", "e").collect()] == [1, 2, 3, 4, 5]
    visits = spark.createDataFrame(
        [("s", "7", "1,2", "null"), ("s", "-1", "1,2", "9"), ("s", "-1", "null", "9"), ("s", "-1", "null", "null")],
        "session_id string, click_category_id string, order_category_ids string, pay_category_ids string",
    )
    assert rows(popularity.category_activity(visits)) == [
        ("1", 0, 1, 0), ("2", 0, 1, 0), ("7", 1, 0, 0), ("9", 0, 0, 1),
    ]


def test_quarantine(spark, folder):
    texts = spark.createDataFrame([("1", "2.5"), ("x", "1"), (None, "3")], "a string, b string")
    found = branch.parse_or_quarantine(texts, {"a": "bigint", "b": "double"})
    assert [tuple(r) for r in found.collect()] == [(1, 2.5, True), (None, 1.0, False), (None, 3.0, True)]
    bad = folder("bad.csv", "sensor_1,1,2.0\nsensor_2,x,2.0\n")
    kept = files.delimited(spark, bad, files.SCHEMAS["sensor"], corrupt="corrupt")
    assert [r["corrupt"] for r in kept.collect()] == [None, "sensor_2,x,2.0"]
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        files.delimited(spark, bad, files.SCHEMAS["sensor"]).collect()


def test_change_records(spark):
    values = spark.createDataFrame(
        [
            (1, '{"database":"d","table":"t","type":"insert","ts":1,"data":{"id":1,"name":"a","age":5}}'),
            (2, '{"database":"d","table":"t","type":"update","ts":2,"data":{"id":1,"name":"b","age":6}}'),
            (3, '{"database":"d","table":"t","type":"insert","ts":2,"data":{"id":2,"name":"c","age":7}}'),
            (4, '{"database":"d","table":"t","type":"delete","ts":3,"data":{"id":2,"name":"c","age":7}}'),
        ],
        "seq bigint, value string",
    )
    changes = external.change_records(values, "id bigint, name string, age int")
    found = synchronised(changes, "id", ["seq"], "cf1", ["name", "age"])
    assert [(r["id"], r["cf1"]["name"], r["cf1"]["age"]) for r in found.collect()] == [(1, "b", 6)]


def test_kept_visits_give_the_same(spark):
    visits = spark.createDataFrame(
        [("s1", "7", "null", "null"), ("s1", "7", "null", "null"), ("s2", "7", "null", "null"), ("s3", "-1", "7,8", "null")],
        "session_id string, click_category_id string, order_category_ids string, pay_category_ids string",
    )
    kept = popularity.category_sessions(visits, keep=True)
    assert rows(kept, "category_id", "session_id", "n", "rank") == [("7", "s1", 2, 1), ("7", "s2", 1, 2)]
    assert visits.storageLevel.useDisk
    visits.unpersist()
    assert rows(popularity.category_sessions(visits)) == rows(kept)


def test_observed_sum(spark):
    df, seen = aggregates.observed(spark.range(5), total=F.sum("id"))
    assert df.where("id > 2").count() == 2
    assert seen.get == {"total": 10}


def test_loaded_table_is_replaced(spark, folder):
    path = folder("city_info.txt", data.CITIES)
    for _ in range(2):
        external.load_table(spark, "city_loaded", path, files.SCHEMAS["city_info"])
    assert spark.table("city_loaded").count() == 26
    spark.sql("DROP TABLE city_loaded")
