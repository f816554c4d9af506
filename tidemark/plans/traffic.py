"""Page views, unique visitors, channel statistics, word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import bitmap_distinct, count_by, distinct_per_window, sketch_count, sketch_store
from tidemark.operators.branch import words
from tidemark.operators.buckets import salted_count
from tidemark.operators.sequences import Measure
from tidemark.operators.windows import sliding, tumbling


def _windowed(behaviours: DataFrame, behaviour: str, size: str) -> DataFrame:
    window = F.window("ts", size).alias("window")
    return behaviours.where(F.col("behaviour") == behaviour).select(window, "user_id", "event_id")


def page_views(behaviours: DataFrame, behaviour: str = "pv", size: str = "1 hour") -> DataFrame:
    seen = behaviours.where(F.col("behaviour") == behaviour)
    return tumbling(seen, "ts", size, [], [F.count(F.lit(1)).alias("n")]).select("window_end", "n")


def page_views_salted(behaviours: DataFrame, behaviour: str = "pv", size: str = "1 hour", salts: int = 10) -> DataFrame:
    """The same in two explicit phases, salted by row id: one window is never one task's work."""
    seen = _windowed(behaviours, behaviour, size)
    counts = salted_count(seen, F.pmod(F.xxhash64("event_id"), F.lit(salts)), [F.col("window.end").alias("window_end")])
    return counts.select("window_end", "n")


def unique_visitors(behaviours: DataFrame, behaviour: str = "pv", size: str = "1 hour") -> DataFrame:
    counts = distinct_per_window(_windowed(behaviours, behaviour, size), "window", "user_id")
    return counts.select(F.col("window.end").alias("window_end"), "uv")


def unique_visitors_bitmap(behaviours: DataFrame, behaviour: str = "pv", size: str = "1 hour") -> DataFrame:
    counts = bitmap_distinct(_windowed(behaviours, behaviour, size), "window", "user_id")
    return counts.select(F.col("window.end").alias("window_end"), "uv")


def visitor_sketches(behaviours: DataFrame, behaviour: str = "pv", pane: str = "1 hour") -> DataFrame:
    """Sketches of the visitors per pane, which later runs add to and any longer window merges."""
    seen = behaviours.where(F.col("behaviour") == behaviour)
    return sketch_store(seen, [F.window("ts", pane).start.alias("pane")], "user_id")


def visitors_from_sketches(store: DataFrame, size: str = "1 day", slide: str = "6 hours") -> DataFrame:
    """Visitors per sliding window from the panes of all runs; a pane, not a row, goes to each of its windows."""
    window = F.window("pane", size, slide)
    return sketch_count(store, [window.end.alias("window_end")])


def channel_counts(
    actions: DataFrame, left_out: str = "UNINSTALL", size: str = "1 hour", slide: str = "5 seconds"
) -> DataFrame:
    """Actions per channel, behaviour and sliding window, one kind of behaviour left out."""
    kept = actions.where(F.col("behaviour") != left_out)
    return sliding(kept, "ts", size, slide, ["channel", "behaviour"], [Measure("n", "sum", F.lit(1).cast("bigint"))])


def word_count(texts: DataFrame, text: str) -> DataFrame:
    """Occurrences of each space-separated word, as written."""
    return count_by(words(texts.select(text), text), ["word"])
