"""Hot items, hot pages, ads per province, categories and their sessions, products per region."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.aggregates import remark_by
from tidemark.operators.aggregates import branch_counts, count_by
from tidemark.operators.branch import first_match, without_static
from tidemark.operators.joins import members_of
from tidemark.operators.ranking import first_rows, top_n, top_ranked
from tidemark.operators.sequences import Measure
from tidemark.operators.windows import sliding
from tidemark.session import scratch_dir


def _ones(name: str = "n") -> Measure:
    return Measure(name, "sum", F.lit(1).cast("bigint"))


def hot_items(
    behaviours: DataFrame,
    behaviour: str = "pv",
    size: str = "1 hour",
    slide: str = "5 minutes",
    n: int = 5,
) -> DataFrame:
    """The n most viewed items of every sliding window; ties by item."""
    seen = behaviours.where(F.col("behaviour") == behaviour)
    counts = sliding(seen, "ts", size, slide, ["item_id"], [_ones()])
    return top_n(counts, ["window_end"], [F.desc("n"), F.asc("item_id")], n)


def hot_pages(
    log: DataFrame, method: str = "GET", size: str = "10 minutes", slide: str = "5 seconds", n: int = 3
) -> DataFrame:
    """The n most requested pages of every sliding window, static resources left out; ties by URL."""
    pages = without_static(log.where(F.col("method") == method), "url")
    counts = sliding(pages, "ts", size, slide, ["url"], [_ones()])
    return top_n(counts, ["window_end"], [F.desc("n"), F.asc("url")], n)


def top_per_group(df: DataFrame, group: str, key: str, n: int = 3) -> DataFrame:
    """The n most frequent keys of each group (ads of a province); ties by key."""
    return top_n(count_by(df, [group, key]), [group], [F.desc("n"), F.asc(key)], n)


def _is_click() -> Column:
    return F.col("click_category_id") != "-1"


def category_activity(visits: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category. A visit counts as the first of them it holds."""
    event = lambda kind, ids: F.transform(ids, lambda i: F.struct(i.alias("category_id"), F.lit(kind).alias("kind")))
    listed = lambda c: F.split(F.col(c), ",")
    cases = [
        (_is_click(), event("click", F.array("click_category_id"))),
        (F.col("order_category_ids") != "null", event("order", listed("order_category_ids"))),
        (F.col("pay_category_ids") != "null", event("pay", listed("pay_category_ids"))),
    ]
    acts = first_match(visits, cases, "_act").select("_act.*")
    kinds = {f"{k}s": F.col("kind") == k for k in ("click", "order", "pay")}
    return branch_counts(acts, ["category_id"], kinds)


def hot_categories(visits: DataFrame, n: int = 10) -> DataFrame:
    """The n categories highest by clicks, then orders, then payments; ties by category."""
    order = [F.desc("clicks"), F.desc("orders"), F.desc("pays"), F.asc("category_id")]
    return first_rows(category_activity(visits), order, n)


def category_sessions(visits: DataFrame, n_categories: int = 10, n_sessions: int = 10, keep: bool = False) -> DataFrame:
    """In each of the hottest categories the sessions with most clicks; ties by session.

    With ``keep`` the visits are stored while both passes read them, until the caller's
    ``visits.unpersist()``. That is worth it if they are costly to make; two column-pruned scans are
    cheaper than storing a large table.
    """
    source = visits.persist(StorageLevel.DISK_ONLY) if keep else visits
    hot = hot_categories(source, n_categories)
    clicks = source.where(_is_click()).select(F.col("click_category_id").alias("category_id"), "session_id")
    counts = count_by(members_of(clicks, hot, "category_id"), ["category_id", "session_id"])
    return top_n(counts, ["category_id"], [F.desc("n"), F.asc("session_id")], n_sessions)


def hot_products_by_region(sales: DataFrame, products: DataFrame, cities: DataFrame, max_rank: int = 2) -> DataFrame:
    """Per area the products of rank 1..max_rank by sales, each with its main cities.

    ``sales`` has one row per sale (product_id, city_id); it is counted by both before the
    dimensions are joined, so no hot product or city is joined row by row. Remarks are made for the
    ranked products only. The counts by area, product and city, far fewer than the sales, are
    written once to the shared folder, as three steps read them.
    """
    counts = count_by(sales, ["product_id", "city_id"])
    named = counts.join(cities, "city_id").join(products, "product_id")
    by_city = named.groupBy("area", "product_name", "city_name").agg(F.sum("n").alias("n"))
    path = scratch_dir(sales.sparkSession, "by_city")
    by_city.write.parquet(path)
    by_city = sales.sparkSession.read.parquet(path)
    totals = by_city.groupBy("area", "product_name").agg(F.sum("n").alias("_total"))
    ranks = top_ranked(totals, ["area"], "_total", max_rank).drop("_total")
    ranked = by_city.join(ranks, ["area", "product_name"])
    return remark_by(ranked, ["area", "product_name", "rank"], "city_name", "n")
