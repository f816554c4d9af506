"""Aggregate functions over built-in aggregates, as columns and for SQL. Nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REST = "其他"


def integer_average(column: str | Column) -> Column:
    """Average rounded towards zero; null on no rows."""
    c = F.col(column) if isinstance(column, str) else column
    return F.call_function("div", F.sum(c), F.count(c))


def city_remark(cities: Column, total: Column, top: int = 2) -> Column:
    """Text such as ``A 45%,B 27%,其他 28%`` from an array of (count, city) and the total count.

    The top cities with whole percents; what remains is given as the rest if there are more cities.
    """
    ranked = F.slice(
        F.array_sort(
            cities,
            lambda a, b: F.when(a["n"] != b["n"], F.when(a["n"] > b["n"], -1).otherwise(1))
            .when(a["city"] < b["city"], -1)
            .when(a["city"] > b["city"], 1)
            .otherwise(0),
        ),
        1,
        top,
    )
    percent = lambda x: F.floor(x["n"] * 100 / total)
    parts = F.transform(ranked, lambda x: F.concat(x["city"], F.lit(" "), percent(x).cast("string"), F.lit("%")))
    shown = F.aggregate(ranked, F.lit(0).cast("bigint"), lambda acc, x: acc + percent(x))
    rest = F.concat(F.lit(f"{REST} "), (100 - shown).cast("string"), F.lit("%"))
    return F.concat_ws(",", F.when(F.size(cities) > top, F.concat(parts, F.array(rest))).otherwise(parts))


def remark_by(counts: DataFrame, keys: list[str], city: str, n: str, top: int = 2) -> DataFrame:
    """Total and city remark per key from counts by key and city; a group holds one row per city."""
    cities = F.collect_list(F.struct(F.col(n).alias("n"), F.col(city).alias("city")))
    return (
        counts.groupBy(*keys)
        .agg(F.sum(n).alias("_total"), cities.alias("_cities"))
        .select(*keys, F.col("_total").alias(n), city_remark(F.col("_cities"), F.col("_total"), top).alias("city_remark"))
    )


def register(spark: SparkSession) -> None:
    """SQL names: int_avg_of(sum, count), avg_of(sum, count) and city_remark_of(cities, total).

    They finish what built-in aggregates have summed, so every group is combined before the shuffle:
    int_avg_of(sum(x), count(x)), city_remark_of(collect_list(struct(n, city)), sum(n)) over counts by city.
    """
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION int_avg_of(total BIGINT, n BIGINT) RETURNS BIGINT
        RETURN if(n = 0, NULL, total div n)
        """
    )
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION avg_of(total DOUBLE, n BIGINT) RETURNS DOUBLE
        RETURN if(n = 0, NULL, total / n)
        """
    )
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION city_remark_of(cities ARRAY<STRUCT<n: BIGINT, city: STRING>>, total BIGINT)
        RETURNS STRING RETURN concat_ws(',',
            transform(slice(array_sort(cities, (a, b) -> CASE
                    WHEN a.n > b.n THEN -1 WHEN a.n < b.n THEN 1
                    WHEN a.city < b.city THEN -1 WHEN a.city > b.city THEN 1 ELSE 0 END), 1, 2),
                c -> concat(c.city, ' ', c.n * 100 div total, '%')),
            if(size(cities) > 2, concat('{REST} ', 100 - aggregate(
                slice(array_sort(transform(cities, c -> -c.n)), 1, 2), 0L, (s, n) -> s + (-n * 100 div total)), '%'), NULL))
        """
    )
