"""Passages that repeat, within a document or between documents, removed by a compacted de Bruijn graph of word k-mers.

An edge of the graph is a run of WINDOW words, from the node of its first WINDOW - 1 words to that of its last ones. Only
edges that occur twice or more matter, and these are few:

1. Every window names its anchor, the run of MER words in it with the least hash. Equal windows have equal anchors, so a
   window whose anchor occurs once occurs once. Anchors are counted, about one for ten words.
2. The windows of repeated anchors become edges, counted with the edge before and after them.
3. Where all occurrences of an edge are followed by the same edge, and all of that one preceded by it, the node between
   has no branch. Joins of the edges with their neighbours find the edges at which unbranched paths open and close.
4. Only those meet their source coordinates again. What lies between an opening and the next closing place in a text is
   an occurrence of one path; occurrences are held against each other by their length and by a second, independent hash
   of their first and last window. (A word that differs changes every window that it is in, and on a path the others are
   chained by the first hash.) A path that is left with one occurrence was a collision and is dropped.
5. The words of the paths' occurrences are removed, and the others are joined by one blank.

Texts are told apart by their content, so copies of one text are worked on once; their number makes their windows repeat.
Null and empty texts have no words; texts with fewer words than a window keep all. Windows may overlap, so a run of equal
words removes itself. All rows are judged on the input. Repeated rows are documents of their own, and remove each other. An
empty table gives an empty result. New columns take the place of columns of the same name.

Nothing is collected by key but the places of one text. A passage that a third of all texts share is a few hot anchors and
edges: they are counted with partial sums and joined by plain joins, which Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from tidemark.llm.common import kept_table, text_of
from tidemark.llm.wordcodes import grams, lots, mixed, places, rejoined, words_of

WINDOW, MER = 35, 16
_SEED = np.uint64(0xA24BAED4963EE407)


def _lists(kind: pa.DataType, values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each width neighbours."""
    span = 1
    while 2 * span <= width:
        values, span = np.minimum(values[: len(values) - span], values[span:]), 2 * span
    return np.minimum(values[: len(values) - (width - span)], values[width - span :])


def anchors(codes: np.ndarray, first: np.ndarray, window: int, mer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts' windows: hashes of their anchors, the text, and which windows (from, to) have it; neighbours share one."""
    counts = np.maximum(np.diff(first) - window + 1, 0)
    at, of = places(first[:-1], counts)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none
    hashes = grams(codes, mer)
    low = np.uint64((1 << max(20, len(codes).bit_length())) - 1)
    tagged = hashes & ~low | np.arange(len(hashes), dtype=np.uint64)
    chosen = (_least(tagged, window - mer + 1)[at] & low).astype(np.int64)
    begins = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    doc, start = of[begins], at[begins] - first[of[begins]]
    to = np.append(start[1:], 0)
    final = np.append(doc[1:] != doc[:-1], True)
    return hashes[chosen[begins]], doc, start, np.where(final, counts[doc], to)


def _sketched(rows: DataFrame, window: int, mer: int) -> DataFrame:
    """One row for each text with a window: __key, and its anchors with the windows (from, to) that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in lots(batch["__text"]):
                words = words_of(batch["__text"].slice(i, j - i))
                found, doc, start, to = anchors(words.codes, words.first, window, mer)
                sizes = np.bincount(doc, minlength=j - i)
                has = sizes > 0
                columns = [(pa.int64(), found.view(np.int64)), (pa.int32(), start), (pa.int32(), to)]
                keys = batch["__key"].slice(i, j - i).filter(pa.array(has))
                lists = [_lists(kind, values, sizes[has]) for kind, values in columns]
                yield pa.RecordBatch.from_arrays([keys, *lists], names=["__key", "anchor", "start", "stop"])

    kind = "__key binary, anchor array<long>, start array<int>, stop array<int>"
    return rows.select("__key", "__text").mapInArrow(run, kind)


def _stretches(texts: DataFrame, window: int) -> DataFrame:
    """By text and stretch of windows that may repeat: the edges, with one before and one after (0: none), and places.

    A place is the number of the window, and in its low 32 bits the second hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            for i, j in lots(batch["__text"]):
                words = words_of(batch["__text"].slice(i, j - i))
                edges = grams(words.codes, window)
                checks = grams(mixed(words.codes ^ _SEED), window) >> np.uint64(32)
                rows, starts, copies, size, edge, place = [], [], [], [], [], []
                for k, part in enumerate(batch.slice(i, j - i).select(["row", "copies", "spots"]).to_pylist()):
                    if part["row"] == before:
                        continue  # a copy; the rows come in the order of their texts
                    before, first = part["row"], int(words.first[k])
                    n = int(words.first[k + 1]) - first - window + 1
                    spots = np.array([(s["start"], s["stop"]) for s in part["spots"]])
                    spots = spots[np.argsort(spots[:, 0])]
                    cut = np.append(True, spots[1:, 0] > np.maximum.accumulate(spots[:, 1])[:-1])
                    for a, b in zip(spots[cut, 0], np.append(spots[:-1, 1][cut[1:]], spots[:, 1].max()), strict=True):
                        mine = np.zeros(b - a + 2, np.uint64)
                        low, high = int(a > 0), int(b < n)
                        mine[1 - low : b - a + 1 + high] = edges[first + a - low : first + b + high]
                        rows.append(before)
                        copies.append(part["copies"])
                        size.append(b - a)
                        edge.append(mine)
                        place.append(np.arange(a, b, dtype=np.uint64) << np.uint64(32) | checks[first + a : first + b])
                if rows:
                    sizes = np.array(size)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(rows, pa.int64()),
                            pa.array(copies, pa.int64()),
                            _lists(pa.int64(), np.concatenate(edge).view(np.int64), sizes + 2),
                            _lists(pa.int64(), np.concatenate(place).view(np.int64), sizes),
                        ],
                        names=["row", "copies", "edges", "places"],
                    )

    return texts.mapInArrow(run, "row long, copies long, edges array<long>, places array<long>")


def _repeated_edges(stretches: DataFrame) -> DataFrame:
    """Edges that occur twice or more: how often (n), and the only edge before or after (null: several, or none)."""
    each = stretches.select("copies", "edges", F.posexplode("places").alias("i", "place")).select(
        F.element_at("edges", F.col("i") + 2).alias("edge"),
        F.element_at("edges", F.col("i") + 1).alias("before"),
        F.element_at("edges", F.col("i") + 3).alias("after"),
        "copies",
    )
    sides = [f(c).alias(f"{n}_{c}") for c in ("before", "after") for n, f in (("low", F.min), ("high", F.max))]
    counted = each.groupBy("edge").agg(F.sum("copies").alias("n"), *sides).filter("n > 1")
    only = lambda c: F.when((F.col(f"low_{c}") == F.col(f"high_{c}")) & (F.col(f"low_{c}") != 0), F.col(f"low_{c}"))
    return counted.select("edge", "n", only("before").alias("before"), only("after").alias("after"))


def _path_ends(edges: DataFrame) -> DataFrame:
    """Edges that open or close an unbranched path: the neighbour has other neighbours, or there are several or none."""
    to = edges.select(F.col("edge").alias("at"), F.col("n").alias("their"))
    opened = edges.join(to, edges["before"] == to["at"], "left").select(
        "edge", "n", "after", (~F.col("n").eqNullSafe(F.col("their"))).alias("opens")
    )
    closed = opened.join(to, opened["after"] == to["at"], "left").select(
        F.col("edge").alias("end"), "opens", (~F.col("n").eqNullSafe(F.col("their"))).alias("closes")
    )
    return closed.filter("opens OR closes")


def repeated_spans(rows: DataFrame, window: int = WINDOW, mer: int = MER) -> DataFrame:
    """From (__key, __text): for each text with a repeated window, __key and spans, the words from start to stop (exclusive)."""
    sketch = kept_table(_sketched(rows, window, mer), "anchors")
    counted = sketch.select(F.explode("anchor").alias("known")).groupBy("known").agg(F.count("*").alias("n"))
    again = kept_table(counted.filter("n > 1").select("known"), "again")
    each = sketch.select("__key", F.explode(F.arrays_zip("anchor", "start", "stop")).alias("a")).select("__key", "a.*")
    hits = each.join(again, each["anchor"] == again["known"]).groupBy("__key", "start", "stop").agg(F.count("*").alias("n"))
    # one text's anchors: no more than its windows
    spots = hits.groupBy("__key").agg(F.collect_list(F.struct("start", "stop")).alias("spots"), F.max("n").alias("copies"))
    spots = kept_table(spots.withColumn("row", F.monotonically_increasing_id()).withColumnRenamed("__key", "key"), "spots")
    texts = rows.join(spots, rows["__key"] == spots["key"]).select("__text", "row", "copies", "spots")
    stretches = kept_table(_stretches(texts, window), "stretches")
    edges = kept_table(_repeated_edges(stretches), "edges")
    ends = kept_table(_path_ends(edges), "ends")
    each = stretches.select("row", "edges", F.posexplode("places").alias("i", "place")).select(
        "row", F.element_at("edges", F.col("i") + 2).alias("edge"), "place"
    )
    marks = each.join(ends, each["edge"] == ends["end"]).select("row", "edge", "place", "opens", "closes")
    later = Window.partitionBy("row").orderBy(F.col("place").desc()).rowsBetween(Window.unboundedPreceding, 0)
    close = F.last(F.when(F.col("closes"), F.col("place")), ignorenulls=True).over(later)
    number, check = lambda c: F.shiftright(c, 32), lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))
    paths = marks.withColumn("close", close).filter("opens").select(
        "row",
        "edge",
        number("place").alias("start"),
        (number("close") - number("place") + 1).alias("windows"),
        check("place").alias("head"),
        check("close").alias("tail"),
    )
    paths = kept_table(paths, "paths")
    path = ["edge", "windows", "head", "tail"]
    weighed = paths.join(spots.select("row", "copies"), "row")
    verified = kept_table(weighed.groupBy(*path).agg(F.sum("copies").alias("n")).filter("n > 1").drop("n"), "verified")
    span = F.struct("start", (F.col("start") + F.col("windows") + (window - 1)).alias("stop"))
    spans = paths.join(verified, path).groupBy("row").agg(F.collect_list(span).alias("spans"))
    return kept_table(spots.select("key", "row").join(spans, "row").select("key", "spans"), "spans")


def remove_repeats(df: DataFrame, text: str = "text", window: int = WINDOW, mer: int = MER) -> DataFrame:
    """df with n_words, n_removed and kept: the text without the words of repeated windows, joined by one blank."""
    columns = [c for c in df.columns if c.lower() not in ("n_words", "n_removed", "kept")]
    content = text_of(df[text])
    named = [F.unhex(F.md5(content.cast("binary"))).alias("__key"), content.alias("__text")]
    spans = repeated_spans(df.select(*named), window, mer)
    marked = df.select(*(df[c] for c in columns), *named)
    marked = marked.join(spans, marked["__key"] == spans["key"], "left")

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            parts = []
            for i, j in lots(texts):
                words = words_of(texts.slice(i, j - i))
                out = np.zeros(len(words.codes) + 1, np.int32)
                for k, found in enumerate(spans.slice(i, j - i).to_pylist()):
                    for span in found or ():
                        out[words.first[k] + span["start"]] += 1
                        out[words.first[k] + span["stop"]] -= 1
                gone = np.cumsum(out[:-1]) > 0
                removed = np.append(0, np.cumsum(gone))[words.first]
                parts.append((pa.array(words.counts()), pa.array(np.diff(removed)), rejoined(words, ~gone)))
            columns = [pa.concat_arrays(c) for c in zip(*parts, strict=True)] if parts else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.string())]
            yield pa.StructArray.from_arrays(columns, names=["n_words", "n_removed", "kept"])

    done = F.arrow_udf(run, "struct<n_words:long,n_removed:long,kept:string>", ArrowUDFType.SCALAR_ITER)
    return marked.select(*columns, done("__text", "spans").alias("__done")).select(*columns, "__done.*")
