"""Approximate nearest neighbours: stable projections, a kd-tree, and a chi-square stopping test.

Vectors are projected to DIMS numbers with Gaussian (2-stable) weights, so the squared projected distance of two vectors
is their squared distance times a chi-square variable with DIMS degrees of freedom. Candidates are met in the order of
projected distance and verified on the original vectors; a search stops when a neighbour nearer than the best so far
would, with probability SURE, have been met already: projected distance^2 > quantile(SURE) * (k-th best distance)^2.

The kd-tree's upper part deals the projected vectors out to cells. It is fitted on a sample of at most SAMPLE vectors, but
every vector is in a cell; a cell of more than CELL vectors is cut into chunks, and all its chunks are searched. A query
first searches its own cell, which bounds its k-th distance, and then all cells that the stopping test doesn't rule out
by their box. Within a chunk the tree goes on down to leaves, taken nearest first until the test holds.

Equal vectors are one point with its smallest k + 1 ids (the query's own may be among them), and equal queries are one
search; the answers are then dealt out. Null vectors, ones that are zero, empty or hold null or non-finite components, and
rows without an id take no part. Vectors of different length don't meet. Repeated rows are one row. Other columns are not
read. Queries with fewer than k candidates return all.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from tidemark.llm.common import arrow_column, kept_table

DIMS, SURE = 8, 0.97
SAMPLE, CELL, LEAF, QUERIES = 65_536, 8192, 128, 4096


def chi_square_quantile(share: float, dims: int = DIMS) -> float:
    """For an even number of degrees of freedom, by bisection of the closed distribution function."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        term, tail = 1.0, 1.0
        for i in range(1, dims // 2):
            term *= x / 2 / i
            tail += term
        low, high = (x, high) if 1 - math.exp(-x / 2) * tail < share else (low, x)
    return high


def project(vectors: np.ndarray) -> np.ndarray:
    weights = np.random.default_rng(vectors.shape[1]).standard_normal((vectors.shape[1], DIMS))
    return vectors @ weights


class Cells:
    """The upper part of the tree: halves the sample along its widest side until cells are small enough."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, self.sides, self.cuts = depth, np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
        parts = {1: sample}
        for node in range(1, 1 << depth):
            part = parts.pop(node)
            side = int(np.argmax(np.ptp(part, axis=0))) if len(part) else 0
            cut = float(np.median(part[:, side])) if len(part) else 0.0
            self.sides[node], self.cuts[node] = side, cut
            parts[2 * node], parts[2 * node + 1] = part[part[:, side] <= cut], part[part[:, side] > cut]

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.sides[node]] > self.cuts[node])
        return node - (1 << self.depth)

    def boxes(self) -> tuple[np.ndarray, np.ndarray]:
        low, high = (np.full((1 << self.depth, DIMS), x) for x in (-np.inf, np.inf))
        for cell in range(1 << self.depth):
            node = cell + (1 << self.depth)
            while node > 1:
                up, side = node >> 1, self.sides[node >> 1]
                if node & 1:
                    low[cell, side] = max(low[cell, side], self.cuts[up])
                else:
                    high[cell, side] = min(high[cell, side], self.cuts[up])
                node = up
        return low, high


def _leaves(points: np.ndarray) -> list[np.ndarray]:
    todo, leaves = [np.arange(len(points))], []
    while todo:
        part = todo.pop()
        side = int(np.argmax(np.ptp(points[part], axis=0)))
        if len(part) <= LEAF:
            leaves.append(part)
            continue
        order = part[np.argpartition(points[part, side], len(part) // 2)]
        todo += [order[: len(part) // 2], order[len(part) // 2 :]]
    return leaves


class Chunk:
    """Points of one chunk, searched leaf by leaf."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]], k: int):
        self.vectors, self.ids, self.k = vectors, ids, k
        self.points = project(vectors)
        self.leaves = _leaves(self.points)
        self.low = np.array([self.points[leaf].min(axis=0) for leaf in self.leaves])
        self.high = np.array([self.points[leaf].max(axis=0) for leaf in self.leaves])
        self.limit = chi_square_quantile(SURE)

    def search(self, query: np.ndarray, bound: float) -> list[tuple[float, int]]:
        """The nearest (distance, id), k + 1 at most, of those within bound that are met before the test holds."""
        point = project(query[None])[0]
        gaps = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        nearest = (gaps * gaps).sum(axis=1)
        best: list[tuple[float, int]] = []
        for i in np.argsort(nearest):
            if nearest[i] > self.limit * bound * bound:
                break
            leaf = self.leaves[i]
            apart = self.points[leaf] - point
            met = leaf[(apart * apart).sum(axis=1) <= self.limit * bound * bound]
            away = np.sqrt(np.square(self.vectors[met] - query).sum(axis=1))
            near = [(d, j) for d, j in zip(away.tolist(), met.tolist(), strict=True) if d <= bound]
            if near:
                best += [(d, name) for d, j in near for name in self.ids[j]]
                best = sorted(best)[: self.k + 1]
                if len(best) > self.k:
                    bound = min(bound, best[-1][0])
        return best


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _clean(df: DataFrame, key: str, vector: str) -> DataFrame:
    v = df[vector].cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    return df.filter(df[key].isNotNull() & F.coalesce(whole, F.lit(False))).select(df[key].cast("long").alias("id"), v.alias("v")).distinct()


def _smallest_ids(rows: DataFrame, n: int) -> DataFrame:
    """One row per vector, with its n smallest ids; those beyond are dropped before the shuffle."""
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    return rows.withColumn("place", place).filter(F.col("place") <= n).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def nearest(df: DataFrame, query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10) -> DataFrame:
    """For the rows where query holds: query_id, rank (from 1), vec_id, score (Euclidean distance); ties to the smaller id."""
    rows = kept_table(_clean(df, key, vector), "vectors")
    asked = kept_table(_clean(df.filter(query), key, vector), "queries")
    points = _smallest_ids(rows, k + 1)
    wanted = asked.groupBy("v").agg(F.min("id").alias("q"))
    found = []
    lengths = [r["n"] for r in rows.select(F.size("v").alias("n")).distinct().collect()]  # at most the longest one's
    for length in sorted(lengths):
        same = F.size("v") == length
        found.append(_search(kept_table(points.filter(same), "points"), kept_table(wanted.filter(same), "wanted"), k))
    schema = "query_id long, rank int, vec_id long, score double"
    if not found:
        return df.sparkSession.createDataFrame([], schema)
    best = found[0]
    for more in found[1:]:
        best = best.union(more)
    names = wanted.select(F.col("v").alias("same"), F.col("q").alias("leader"))
    leaders = asked.join(names, asked["v"] == names["same"]).select(F.col("id").alias("query_id"), "leader")
    answers = leaders.join(best, leaders["leader"] == best["q"]).filter("query_id <> vec_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(points: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Per distinct query q: the k + 1 nearest (vec_id, score), itself among them."""
    n, asked = points.count(), wanted.count()
    depth = min(16, max(0, math.ceil(math.log2(max(1, n / CELL)))))
    share = min(1.0, SAMPLE / max(1, n))
    sample = points.select("v").sample(share, seed=1).limit(2 * SAMPLE).toPandas()["v"] if depth else []
    cells = Cells(project(np.stack(sample)) if len(sample) else np.zeros((0, DIMS)), depth)
    low, high = cells.boxes()
    limit = chi_square_quantile(SURE)

    def home(batch: pa.Array) -> pa.Array:
        return pa.array(cells.of(project(_matrix(batch))) if len(batch) else [], pa.int32())

    in_cell = arrow_column(home, "int")
    placed = points.withColumn("cell", in_cell("v"))
    placed = kept_table(placed, "placed")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / CELL).alias("chunks"))  # at most 65536 rows
    parts = max(1, math.ceil(asked / QUERIES))
    placed = placed.join(F.broadcast(sizes), "cell").select(
        "cell", F.pmod(F.xxhash64(F.col("ids")[0]), F.col("chunks")).alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "v", "ids",
    )
    first = kept_table(wanted.withColumn("cell", in_cell("v")).withColumn("bound", F.lit(float("inf"))), "first")

    def answer(asked: DataFrame) -> DataFrame:
        """The nearest in the cells asked for: q and lists of (score, vec_id)."""
        asked = asked.join(F.broadcast(sizes), "cell").select(
            F.col("cell").alias("at"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("at_chunk"),
            F.pmod(F.xxhash64("q"), F.lit(parts)).cast("int").alias("at_part"), "q", F.col("v").alias("w"), "bound",
        )

        def search(here: pa.Table, queries: pa.Table) -> pa.Table:
            out = []
            if len(here) and len(queries):
                chunk = Chunk(_matrix(here["v"].combine_chunks()), here["ids"].to_pylist(), k)
                for q, w, bound in zip(
                    queries["q"].to_pylist(), _matrix(queries["w"].combine_chunks()), queries["bound"].to_pylist(), strict=True
                ):
                    out += [(q, d, name) for d, name in chunk.search(w, bound)]
            columns = list(zip(*out, strict=True)) or [[], [], []]
            kinds = (pa.int64(), pa.float64(), pa.int64())
            return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["q", "score", "vec_id"])

        grouped = placed.groupBy("cell", "chunk", "part").cogroup(asked.groupBy("at", "at_chunk", "at_part"))
        return grouped.applyInArrow(search, "q long, score double, vec_id long")

    def ranked(found: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id"))
        return found.withColumn("place", place).filter(F.col("place") <= k + 1)

    near = kept_table(ranked(answer(first)), "near")
    if depth == 0:
        return near.drop("place")
    bounds = near.groupBy("q").agg(F.max("score").alias("worst"), F.count("*").alias("n"))
    bound = F.when(F.col("n") > k, F.col("worst")).otherwise(float("inf"))

    def others(vectors: pa.Array, bounds: pa.Array, homes: pa.Array) -> pa.Array:
        said = []
        for point, bound, cell in zip(project(_matrix(vectors)), bounds.to_pylist(), homes.to_pylist(), strict=True):
            gaps = np.maximum(np.maximum(low - point, point - high), 0)
            there = np.flatnonzero((gaps * gaps).sum(axis=1) <= limit * bound * bound)
            said.append(there[there != cell].tolist())
        return pa.array(said, pa.list_(pa.int32()))

    def run(batches):
        for batch in batches:
            yield others(*batch)

    more = F.arrow_udf(run, "array<int>", ArrowUDFType.SCALAR_ITER)
    second = first.drop("bound").join(bounds, "q").withColumn("bound", bound)
    second = second.withColumn("cell", F.explode(more("v", "bound", "cell"))).select("q", "v", "cell", "bound")
    return ranked(near.drop("place").union(answer(second))).drop("place")

