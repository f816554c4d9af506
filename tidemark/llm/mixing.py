"""Mixing sources to target weights by entropy balancing.

Each source has a target in words. Among all document rates between 0 and most that give the source its target, those
with the highest entropy (nearest to rate 1) are exponentially tilted: rate = min(most, exp(tilt * size / mean size)).
The tilt is the optimum of a convex dual with one unknown per source, found by Newton steps that are kept inside a
bracket. Each step is one aggregation over the sources' size histograms, for all sources at once; nothing is collected.

Rates become whole copies slice by slice: a slice's documents go from the longest to the shortest, each rounded so that
the words owed so far come nearest to zero, within rate's two neighbours. What is left over is less than the size of a
short document. A source of any size is cut into slices, so no source meets in one task.

Null texts have size 0; documents of size 0 are not taken. The null source is the last one. Repeated rows are rounded
each for itself. An empty table gives an empty result. New columns take the place of columns of the same name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import WORD, kept_table, text_of

SLICE = 2048
#: Newton steps; what has not converged then is halved until it has.
STEPS = 50


def numbered(per_source: DataFrame) -> DataFrame:
    """Adds number, from 0 in code point order of source, null last; sorted by ranges, not in one task."""
    order = F.col("source").asc_nulls_last()
    ranged = per_source.repartitionByRange(order).withColumn("part", F.spark_partition_id())
    ranged = kept_table(ranged, "ranged")
    parts = ranged.groupBy("part").agg(F.count("*").alias("rows"))  # as many rows as partitions
    ahead = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", ahead.alias("ahead"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order))
    return ranged.withColumn("place", place).join(parts, "part").withColumn("number", F.col("ahead") + F.col("place") - 1)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, share: float = 1.0) -> DataFrame:
    """From (source, size): source, source_size, documents, target. Targets share the sum of all sizes by weight, up to most times the source's own."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    cycle = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("number") % len(weights) + 1).cast("int"))
    per = kept_table(numbered(per).select("source", "source_size", "documents", cycle.alias("weight")), "sources")
    total = (per.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = None, -1
    while True:  # the excess of sources at their limit goes to the others, until no other is above
        over = F.lit(False) if level is None else F.col("weight") * level > F.col("source_size") * most
        said = per.agg(
            F.sum(F.when(over, F.col("source_size") * most)).alias("held"),
            F.sum(F.when(~over, F.col("weight"))).alias("free"),
            F.count(F.when(over, 1)).alias("capped"),
        ).first()
        if not said["free"] or said["capped"] == capped:
            break
        level, capped = (total - (said["held"] or 0.0)) / said["free"], said["capped"]
    full = F.col("source_size") * most
    target = F.least(full, F.col("weight") * F.lit(level)) if said["free"] else full
    return kept_table(per.withColumn("target", target.cast("double")), "targets")


def tilts(sizes: DataFrame, targets: DataFrame, most: float = 3.0) -> DataFrame:
    """Per source: tilt and scale (its mean size). A source without words, or with target 0, has no tilt (null)."""
    bars = sizes.filter(F.col("size") > 0).groupBy("source", "size").agg(F.count("*").alias("docs"))
    bars = kept_table(bars.withColumnRenamed("source", "of"), "bars")
    shape = bars.groupBy("of").agg(
        F.min("size").alias("least"), (F.sum(F.col("size") * F.col("docs")) / F.sum("docs")).alias("scale")
    )
    ratio = F.col("target") / F.col("source_size")
    state = (
        targets.join(shape, targets["source"].eqNullSafe(shape["of"]))
        .drop("of")
        .filter("target > 0")
        .withColumn("low", F.least(F.log(ratio), F.lit(0.0)) * F.col("scale") / F.col("least"))
        .withColumn("high", F.when(ratio > 1, math.log(most) * F.col("scale") / F.col("least")).otherwise(0.0))
        .withColumn("tilt", F.when(ratio >= most, F.col("high")).otherwise(F.greatest(F.log(ratio), F.col("low"))))
        .withColumn("done", ratio >= most)
    )
    state = kept_table(state, "tilts")
    rounds = 0
    while state.filter(~F.col("done")).head(1):
        rounds += 1
        pull = F.exp(F.col("tilt") * F.col("size") / F.col("scale"))
        words = (F.col("size") * F.col("docs")).cast("double")
        live = state.filter(~F.col("done"))
        sums = (
            bars.join(live, bars["of"].eqNullSafe(live["source"]))
            .groupBy("of")
            .agg(
                F.sum(words * F.least(pull, F.lit(most))).alias("taken"),
                F.sum(F.when(pull < most, words * pull * F.col("size") / F.col("scale"))).alias("slope"),
            )
        )
        gap = F.col("taken") - F.col("target")
        step = F.col("tilt") - gap / F.col("slope")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        moved = state.join(sums, state["source"].eqNullSafe(sums["of"]), "left").drop("of")
        narrow = F.col("high") - F.col("low") <= 1e-12 * (F.abs(F.col("low")) + F.abs(F.col("high")))
        moved = moved.withColumn("near", F.col("done") | (F.abs(gap) <= 1e-7 * F.col("target")) | narrow)
        moved = moved.withColumns({"low": F.when(F.col("near"), F.col("low")).otherwise(low), "high": F.when(F.col("near"), F.col("high")).otherwise(high), "step": step})
        inside = F.lit(rounds <= STEPS) & (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        tilt = F.when(F.col("near"), F.col("tilt")).when(inside, F.col("step")).otherwise((F.col("low") + F.col("high")) / 2)
        state = kept_table(
            moved.withColumn("tilt", tilt).withColumn("done", F.col("near")).drop("near", "step", "taken", "slope"), "tilts"
        )
    return state.select("source", "tilt", "scale")


def _rounded(size: np.ndarray, rate: np.ndarray) -> np.ndarray:
    copies, owed = np.zeros(len(size), np.int64), 0.0
    for i, (words, r) in enumerate(zip(size.tolist(), rate.tolist(), strict=True)):
        if words > 0:
            floor = math.floor(r + 1e-9)
            chosen = min(max(round(r + owed / words), floor), floor + (r - floor > 1e-9))
            owed += (r - chosen) * words
            copies[i] = chosen
    return copies


def with_size(df: DataFrame, text: str = "text", size: str = "size") -> DataFrame:
    return df.withColumn(size, F.regexp_count(text_of(df[text]), F.lit(WORD)).cast("long"))


def mix(
    df: DataFrame, size: str = "size", source: str = "source", key: str = "doc_id",
    weights: tuple[int, ...] = (1, 2, 3), most: int = 3, share: float = 1.0,
) -> DataFrame:
    """Adds source_size, target, copies and taken (size times copies) to every row. Order of rows doesn't matter: a slice
    is sorted by size, a hash of the key and a hash of the row."""
    sizes = df.select(df[source].alias("source"), F.coalesce(df[size], F.lit(0)).cast("long").alias("size"))
    sizes = kept_table(sizes, "sizes")
    targets = source_targets(sizes, weights, most, share)
    tilted = tilts(sizes, targets, most).withColumnRenamed("source", "tilted")
    known = targets.join(tilted, targets["source"].eqNullSafe(tilted["tilted"]), "left").select(
        F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
        F.ceil(F.col("documents") / SLICE).alias("__slices"), F.col("tilt").alias("__tilt"), F.col("scale").alias("__scale"),
    )
    rows = df.join(kept_table(known, "known"), df[source].eqNullSafe(F.col("__source")))
    words = F.coalesce(df[size], F.lit(0)).cast("long")
    pull = F.exp(F.col("__tilt") * words / F.col("__scale"))
    plain = [df[c] for c, kind in df.dtypes if not kind.startswith("map")]
    rows = rows.select(
        *(df[c] for c in df.columns if c.lower() not in {"source_size", "target", "copies", "taken"}),
        F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), words.alias("__size"),
        F.least(F.coalesce(pull, F.lit(0.0)), F.lit(float(most))).alias("__rate"),
        F.struct("__source", F.pmod(F.xxhash64(df[key]), "__slices").alias("slice")).alias("__slice"),
        F.xxhash64(F.lit("mix"), df[key]).alias("__mixed"), F.xxhash64(*plain).alias("__row"),
    )
    kept = [f for f in rows.schema if not f.name.startswith("__")]
    out = T.StructType([*kept, T.StructField("copies", T.LongType()), T.StructField("taken", T.LongType())])
    names = out.fieldNames()

    def rounded(part: pa.Table) -> pa.Table:
        part = part.sort_by([("__size", "descending"), ("__mixed", "ascending"), ("__row", "ascending")])
        size, rate = part["__size"].to_numpy(), part["__rate"].to_numpy()
        copies = _rounded(size, rate)
        return part.append_column("copies", pa.array(copies)).append_column("taken", pa.array(copies * size)).select(names)

    return rows.groupBy("__slice").applyInArrow(rounded, out)
