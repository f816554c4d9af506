"""Near-duplicate documents: consistent weighted sampling over TF-IDF word shingles, banded and verified.

A text's shingles are its runs of five words (a shorter text is one shingle), where words are runs of characters other
than blank and U+0009 to U+000D. A shingle weighs (1 + ln tf) * (1 + DAMP * idf), idf scaled to 0 .. 1. Document
frequencies come from a sketch of fixed size: shingles are counted over all documents in 2^18 hashed cells, so idf
depends on the share of documents and the sketch doesn't grow. idf is damped because a text that is copied often makes
its own shingles common: undamped, the single words that a copy changes would outweigh all that it shares.

Improved consistent weighted sampling draws BANDS * ROWS samples of each text; two texts draw the same sample with a
probability equal to their weighted Jaccard similarity. ROWS samples make a band; texts that share a band are candidates,
which a pair of similarity 0.8 is with a probability of 0.999. A pair is linked if its weighted Jaccard similarity is at
least 0.8. Classes are the connected components of the links.

In every band the text that collides most over all bands is the pivot, with which all others are compared. That links
nearly all. What is left are bands whose texts are in different components. For these, all pairs of texts of different
components are found that exact bounds leave: their weights must be in a ratio of 0.8, and the cells in which their marks
(the parity of the shingles in each of 512 cells) differ must not exceed the weight that they may not share. Two texts
meet in the first band that they share; those without a shared band at a rare shingle: in the order of rarity, what
follows the first shingle that two texts share must suffice for 0.8 in both. So no link between candidates is lost, and
texts that are linked already never meet. Of those with a bucket or a rare shingle in common, those of the most frequent
component don't meet each other.

Equal texts are one node, whatever their number; nothing is compared twice for them. Null and empty texts are equal
texts. A text without words has no shingle and only equals its copies. Class ids are the smallest doc_id of the class
(null if it has none); rows with the same doc_id and different texts are told apart. Nothing is capped: a band of any
size is joined with its pivot by a skew-safe join, and the members of a hot pivot are split over tasks, by number and bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_column, forget, kept_table, text_of
from tidemark.llm.graph import components
from tidemark.llm.wordcodes import grams, lots, mixed, words_of

SHINGLE, LEAST = 5, 0.8
BANDS, ROWS = 10, 3
CELL_BITS = 18
DAMP = 0.25
#: Texts, and bytes of them, that one task compares with a pivot at a time.
MEMBERS, BYTES = 256, 16 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

#: 64-bit numbers of a text's marks, and their columns.
MARKS = 8
MARK = [f"m{i}" for i in range(MARKS)]
BUCKETS = [f"b{i}" for i in range(BANDS)]

Shingles = tuple[np.ndarray, np.ndarray]


def shingled(texts: pa.Array) -> Iterator[list[Shingles]]:
    """Lot by lot, each text's distinct shingles, as ascending 64-bit hashes, and how often each occurs."""
    for i, j in lots(texts):
        words = words_of(texts.slice(i, j - i))
        keys, found = grams(words.codes, SHINGLE), []
        for a, n in zip(words.first.tolist(), words.counts().tolist()):
            if n >= SHINGLE:
                found.append(np.unique(keys[a : a + n - SHINGLE + 1], return_counts=True))
            else:
                found.append((mixed(grams(words.codes[a : a + n], n) + np.uint64(n)), np.ones(min(n, 1), np.int64)))
        yield found


def shingles(text: str) -> Shingles:
    return next(shingled(pa.array([text])))[0]


def _cells(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """From (text): documents by cell of the sketch, and documents with words. 2^18 numbers, however many documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, docs = np.zeros(1 << CELL_BITS, np.int64), 0
        for batch in batches:
            for lot in shingled(batch["text"]):
                docs += sum(len(keys) > 0 for keys, _ in lot)
                cells += np.bincount(_cells(np.concatenate([keys for keys, _ in lot])), minlength=len(cells))
        used = np.flatnonzero(cells)
        numbers, counts = np.append(used, -1), np.append(cells[used], docs)
        yield pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int32)), pa.array(counts)], names=["cell", "n"])

    found = texts.mapInArrow(counted, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    cells = np.zeros(1 << CELL_BITS, np.int64)
    known = found[found["cell"] >= 0]
    cells[known["cell"].to_numpy()] = known["n"].to_numpy()
    return cells, int(found.loc[found["cell"] < 0, "n"].sum())


def idf_weights(cells: np.ndarray, docs: int) -> np.ndarray:
    """The weight of one occurrence, by cell: from 1 (in every document) to 1 + DAMP (in none)."""
    scale = np.log1p(docs) or 1.0
    return (1 + DAMP * np.clip(np.log((docs + 1) / (cells + 1)) / scale, 0, 1)).astype(np.float32)


def weights(keys: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(counts)) * idf[_cells(keys)]


@lru_cache(maxsize=1)
def _gamma() -> tuple[np.ndarray, np.ndarray]:
    """4096 quantiles of the gamma distribution with shape 2, and their logarithms."""
    wanted, x = (np.arange(4096) + 0.5) / 4096, np.full(4096, 2.0)
    low, high = np.zeros(4096), np.full(4096, 40.0)
    for _ in range(80):
        x = (low + high) / 2
        below = 1 - np.exp(-x) * (1 + x) < wanted
        low, high = np.where(below, x, low), np.where(below, high, x)
    return x.astype(np.float32), np.log(x).astype(np.float32)


def samples(keys: np.ndarray, log_weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row per text, one consistent weighted sample (as a 32-bit hash of shingle and level) per column."""
    gamma, log_gamma = _gamma()
    low, half, unit = np.uint64(4095), np.uint64(32), np.float32(2.0**-20)
    out = np.empty((len(starts), BANDS * ROWS), np.uint64)
    for k, seed in enumerate(np.arange(1, out.shape[1] + 1, dtype=np.uint64) * _A):
        drawn = mixed(keys ^ seed)
        drawn *= _A
        r = gamma[(drawn & low).astype(np.int32)]
        beta = ((drawn >> np.uint64(12)) & np.uint64(0xFFFFF)).astype(np.float32) * unit
        level = np.floor(log_weights / r + beta)
        cost = log_gamma[(drawn >> half & low).astype(np.int32)] - r * (level - beta + np.float32(1))
        bits = cost.astype(np.float32).view(np.int32)
        order = (bits ^ ((bits >> 31) | np.int32(-(2**31)))).view(np.uint32).astype(np.uint64)
        name = (drawn + level.astype(np.int64).view(np.uint64) * _B) * _A >> half
        out[:, k] = np.minimum.reduceat(order << half | name, starts) & np.uint64(0xFFFFFFFF)
    return out


def _bands(texts: pa.Array, idf: np.ndarray) -> pa.StructArray:
    """Weight of each text, and by band its bucket; null for a text without words."""
    weight, buckets, none = [], [[] for _ in range(BANDS)], []
    for lot in shingled(texts):
        while lot:
            take, size = 0, 0
            while take < len(lot) and (size < 1 << 15 or take == 0):
                size += len(lot[take][0])
                take += 1
            now, lot = lot[:take], lot[take:]
            sizes = np.array([len(keys) for keys, _ in now])
            filled = sizes > 0
            none.append(~filled)
            all_weights = np.zeros(len(now))
            drawn = np.zeros((len(now), BANDS * ROWS), np.uint64)
            if filled.any():
                keys = np.concatenate([keys for keys, _ in now])
                starts = (np.cumsum(sizes) - sizes)[filled]
                heavy = weights(keys, np.concatenate([counts for _, counts in now]), idf)
                all_weights[filled] = np.add.reduceat(heavy, starts)
                drawn[filled] = samples(keys, np.log(heavy).astype(np.float32), starts)
            weight.append(all_weights)
            for band in range(BANDS):
                bucket = np.full(len(now), band + 1, np.uint64)
                for part in drawn[:, band * ROWS : (band + 1) * ROWS].T:
                    bucket = mixed((bucket ^ part) * _A)
                buckets[band].append(bucket.view(np.int64))
    empty = np.concatenate(none) if none else np.zeros(0, bool)
    columns = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64(), mask=empty) for c in buckets]
    weight = pa.array(np.concatenate(weight) if weight else np.zeros(0))
    return pa.StructArray.from_arrays([weight, *columns], names=["weight", *BUCKETS])


def similarities(pivot: Shingles, others: list[Shingles], idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of a text with each of the others."""
    sizes = np.array([len(keys) for keys, _ in others], np.int64)
    out, filled = np.zeros(len(others)), sizes > 0
    if not len(pivot[0]) or not filled.any():
        return out
    mine = weights(*pivot, idf)
    keys = np.concatenate([keys for keys, _ in others])
    heavy = weights(keys, np.concatenate([counts for _, counts in others]), idf)
    at = np.minimum(np.searchsorted(pivot[0], keys), len(mine) - 1)
    least = np.where(pivot[0][at] == keys, np.minimum(heavy, mine[at]), 0)
    starts = (np.cumsum(sizes) - sizes)[filled]
    shared = np.add.reduceat(least, starts)
    out[filled] = shared / (mine.sum() + np.add.reduceat(heavy, starts) - shared)
    return out


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _distinct_texts(rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """One row per text: __key, smallest id, rows with that id, rows, bytes, weight, and the bucket of each band."""
    kind = f"struct<weight:double,{','.join(f'{n}:long' for n in BUCKETS)}>"
    signed = rows.select("__id", "__key", F.octet_length("__text").alias("size"), arrow_column(lambda b: _bands(b, idf), kind)("__text").alias("b"))
    same = [F.max(n).alias(n) for n in ("size", "weight", *BUCKETS)]
    ids = signed.select("__id", "__key", "size", "b.*").groupBy("__key", "__id").agg(F.count("*").alias("rows"), *same)
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), "rows")).alias("first")
    return ids.groupBy("__key").agg(first, F.sum("rows").alias("copies"), *same)


def _given(wanted: DataFrame, texts: DataFrame, rows: DataFrame) -> DataFrame:
    """__key and text of the wanted keys (want); once for each row that repeats the first in full."""
    wanted = wanted.join(texts, wanted["want"] == texts["__key"]).select("want", F.col("first.id").alias("want_id"))
    there = (rows["__key"] == wanted["want"]) & rows["__id"].eqNullSafe(wanted["want_id"])
    return rows.join(wanted, there).select("__key", F.col("__text").alias("text"))


def _verified(pairs: DataFrame, given: DataFrame, idf: np.ndarray) -> DataFrame:
    """The pairs (a, b, size of a) that are similar; b is the pivot, and its members are split over tasks."""
    many = F.greatest(F.ceil(F.count("*") / MEMBERS), F.ceil(F.sum("size") / BYTES))
    parts = kept_table(pairs.groupBy(F.col("b").alias("pivot")).agg(many.alias("parts")), "parts")
    member = pairs.join(parts, pairs["b"] == parts["pivot"]).select(
        F.col("a").alias("want"), F.col("b").alias("group"), F.pmod(F.xxhash64("a"), F.col("parts")).alias("part")
    )
    pivot = parts.select("pivot", F.col("pivot").alias("group"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    wanted = member.union(pivot)
    each = wanted.join(given, wanted["want"] == given["__key"]).select("group", "part", "want", "text")

    def similar(rows: pa.Table) -> pa.Table:
        names, group = rows["want"].to_pylist(), rows["group"][0].as_py()
        texts = rows["text"].combine_chunks()
        found = set()
        if group in names:
            pivot = next(shingled(texts.slice(names.index(group), 1)))[0]
            at = 0
            for lot in shingled(texts):
                near = similarities(pivot, lot, idf) >= LEAST - 1e-9
                found.update(names[at + i] for i in np.flatnonzero(near))
                at += len(lot)
        found = sorted(found - {group})
        return pa.table({"a": pa.array(found, pa.binary()), "b": pa.array([group] * len(found), pa.binary())})

    return each.groupBy("group", "part").applyInArrow(similar, "a binary, b binary")


def _prefix(found: Shingles, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of a text, and what each weighs together with all that are less rare.

    Near texts share one of them: all that two texts share stands, in the order of rarity, from the first that they share
    on, and that must be enough for LEAST.
    """
    keys, counts = found
    heavy = weights(keys, counts, idf)
    order = np.lexsort((keys, -idf[_cells(keys)]))
    tail = np.cumsum(heavy[order][::-1])[::-1]
    some = tail >= (LEAST - 1e-6) * heavy.sum()
    return keys[order][some], tail[some]


def marks(found: list[Shingles]) -> np.ndarray:
    """One row of MARKS numbers per text: by cell, whether an odd number of its distinct shingles fall there.

    Cells in which two texts differ hold a shingle that only one of them has, and every shingle weighs 1 or more. So the
    differing cells are no more than the weight that the two don't share, however many shingles there are.
    """
    cells = 64 * MARKS
    out = np.zeros((len(found), cells), np.uint8)
    for row, (keys, _) in zip(out, found, strict=True):
        row[:] = np.bincount(((keys * _B) >> np.uint64(40)).astype(np.int64) % cells, minlength=cells) & 1
    return np.packbits(out, axis=1).view(np.int64)


def _rare(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """From texts with __key and text: of, its rare shingles with their tails (found), and its marks."""

    def run(batch: pa.Array) -> pa.Array:
        found, drawn = [], [np.zeros((0, MARKS), np.int64)]
        for lot in shingled(batch):
            found += [_prefix(one, idf) for one in lot]
            drawn.append(marks(lot))
        ends = pa.array(np.append(0, np.cumsum([len(keys) for keys, _ in found])).astype(np.int32))
        keys = np.concatenate([keys for keys, _ in found] or [np.zeros(0, np.uint64)]).view(np.int64)
        tails = np.concatenate([tail for _, tail in found] or [np.zeros(0)])
        pairs = pa.StructArray.from_arrays([pa.array(keys), pa.array(tails)], names=["rare", "tail"])
        columns = [pa.array(np.ascontiguousarray(c)) for c in np.concatenate(drawn).T]
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, pairs), *columns], names=["found", *MARK])

    kind = f"struct<found:array<struct<rare:long,tail:double>>,{','.join(f'{m}:long' for m in MARK)}>"
    each = arrow_column(run, kind)("text").alias("r")
    return texts.select(F.col("__key").alias("of"), each).select("of", "r.*").dropDuplicates(["of"])


def _little_differs(names: list[str], weight: Column) -> Column:
    """Whether a row and its x_ row differ in no more cells than the weight that texts of similarity LEAST don't share."""
    cells = reduce(Column.__add__, (F.bit_count(F.col(m).bitwiseXOR(F.col(f"x_{m}"))) for m in names))
    return cells <= (1 - 2 * (LEAST - 1e-6) / (1 + LEAST)) * weight


def _met(each: DataFrame, by: list[str], mine: list[str], main: DataFrame, near: Column) -> DataFrame:
    """Pairs (a, b, size of a) of rows of different components with the same by, where near holds; columns of b begin with x_.

    Of the rows with the same by, those of the most frequent component don't meet each other.
    """
    each = kept_table(each.join(main, by), "each")
    x = each.filter("component <> main").select(*(F.col(c).alias(f"x_{c}") for c in (*by, "__key", "component", *mine)))
    apart = (F.col("component") != F.col("x_component")) & (
        (F.col("component") == F.col("main")) | (F.col("__key") < F.col("x___key"))
    )
    same = reduce(Column.__and__, (F.col(f"x_{c}") == F.col(c) for c in by))
    pairs = x.join(each, same & apart & near).select(F.col("__key").alias("a"), F.col("x___key").alias("b"), "size")
    pairs = kept_table(pairs.distinct(), "pairs")
    forget(each)
    return pairs


def _main(each: DataFrame, by: list[str]) -> DataFrame:
    """By what several components share: the most frequent component."""
    by_part = each.groupBy(*by, "component").agg(F.count("*").alias("n"))
    found = by_part.groupBy(*by).agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
    return kept_table(found.filter("parts > 1").select(*by, "main"), "main")


def _leftover_pairs(bands: DataFrame, found: DataFrame, signed: DataFrame, given: DataFrame, idf: np.ndarray) -> list[DataFrame]:
    """Pairs (a, b, size of a) of different components that may be near, among the texts of bands with several components.

    First those that share a band, then the others, which share a rare shingle.
    """
    known = found.select(F.col("node").alias("at"), "component")
    here = bands.join(known, bands["__key"] == known["at"], "left").withColumn("component", F.coalesce("component", "__key"))
    here = kept_table(here.select("bucket", "__key", "weight", "size", "component"), "bands")
    several = _main(here, ["bucket"])
    texts = here.join(several.select("bucket"), "bucket").drop("bucket").distinct()
    unsettled = kept_table(texts, "unsettled")
    rare = _rare(unsettled.select(F.col("__key").alias("want")).join(given, F.col("want") == given["__key"]), idf)
    texts = unsettled.join(signed.select("__key", *BUCKETS), "__key").join(rare, F.col("__key") == F.col("of")).drop("of")
    texts = kept_table(texts, "rare")
    weight = F.col("weight") + F.col("x_weight")
    even = F.least("weight", "x_weight") >= (LEAST - 1e-6) * F.greatest("weight", "x_weight")
    same = [F.col(b) == F.col(f"x_{b}") for b in BUCKETS]
    # texts that share a band meet in the first that they share
    each = texts.select("__key", "weight", "size", "component", *BUCKETS, *MARK, F.posexplode(F.array(*BUCKETS)).alias("band", "bucket"))
    earlier = reduce(Column.__or__, (s & (F.col("band") > i) for i, s in enumerate(same)))
    near = even & _little_differs(MARK, weight) & ~earlier
    pairs = _met(each, ["bucket"], ["weight", "band", *BUCKETS, *MARK], several, near & (F.col("band") == F.col("x_band")))
    # others at rare shingles, with marks of half the cells: two cells taken together are odd if one of them is
    halves = [F.col(a).bitwiseXOR(F.col(b)).alias(a) for a, b in zip(MARK[::2], MARK[1::2], strict=True)]
    each = texts.select("__key", "weight", "size", "component", *BUCKETS, *halves, F.explode("found").alias("r")).select("*", "r.*").drop("r")
    main = _main(texts.select("component", F.explode("found.rare").alias("rare")), ["rare"])
    enough = F.least("tail", "x_tail") >= (LEAST - 1e-6) / (1 + LEAST) * weight
    near = even & enough & _little_differs(MARK[::2], weight) & ~reduce(Column.__or__, same)
    others = _met(each, ["rare"], ["weight", "tail", *BUCKETS, *MARK[::2]], main, near)
    forget(here, several, unsettled, texts, main)
    return [pairs, others]


def _linked(texts: DataFrame, rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """Node and component of all texts that are like another."""
    buckets = F.explode(F.array(*BUCKETS)).alias("bucket")
    bands = texts.filter("b0 IS NOT NULL").select("__key", "weight", "size", buckets)
    # tables that a bucket's rows meet are written first: a join of two plain shuffles can split a hot bucket
    crowd = kept_table(bands.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "crowd")
    crowded = kept_table(bands.join(crowd, "bucket"), "bands")
    degree = kept_table(crowded.groupBy(F.col("__key").alias("node")).agg(F.sum("n").alias("degree")), "degree")
    bands = crowded.join(degree, crowded["__key"] == degree["node"]).select("bucket", "__key", "weight", "size", "degree")
    bands = kept_table(bands, "bands")
    given = kept_table(_given(degree.select(F.col("node").alias("want")), texts, rows), "given")
    order = Window.partitionBy("bucket").orderBy(F.col("degree").desc(), "__key")
    first = bands.withColumn("place", F.row_number().over(order)).filter("place = 1")
    first = kept_table(first.select("bucket", F.col("__key").alias("b"), F.col("weight").alias("their")), "first")
    ratio = F.least("weight", "their") >= (LEAST - 1e-6) * F.greatest("weight", "their")
    pairs = bands.join(first, "bucket").filter((F.col("__key") != F.col("b")) & ratio)
    pairs = kept_table(pairs.select(F.col("__key").alias("a"), "b", "size").distinct(), "pairs")
    forget(crowd, crowded, degree, first)
    links = kept_table(_verified(pairs, given, idf), "links")
    found = components(links)
    left = _leftover_pairs(bands, found, texts, given, idf)
    more = kept_table(_verified(left[0].union(left[1]), given, idf), "links")
    if more.head(1):
        found = components(links.union(more))
    forget(bands, given, pairs, *left)
    return found


def _classes(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    rows = df.select(df[key].alias("__id"), text_of(df[text]).alias("__text"))
    rows = rows.withColumn("__key", _key(F.col("__text")))
    idf = idf_weights(*document_frequencies(rows.select(F.col("__text").alias("text"))))
    texts = kept_table(_distinct_texts(rows, idf), "texts")
    known = _linked(texts, rows, idf)
    named = texts.join(known, texts["__key"] == known["node"], "left").select(
        F.col("__key").alias("text_key"), "first", "copies", F.coalesce("component", "__key").alias("class_key")
    )
    named = kept_table(named, "named")
    whole = named.groupBy(F.col("class_key").alias("class")).agg(
        F.min(F.struct("first.none", "first.id", F.col("text_key").alias("key"), "first.rows")).alias("best"),
        F.sum("copies").alias("class_size"),
    )
    whole = kept_table(named.join(whole, named["class_key"] == whole["class"]).drop("class"), "classes")
    forget(texts, known, named)
    return rows, whole


def classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key (as doc_id), class_id and class_size (documents in it)."""
    rows, found = _classes(df, key, text)
    joined = rows.select("__id", "__key").join(found, F.col("__key") == F.col("text_key"))
    return joined.select(F.col("__id").alias("doc_id"), F.col("best.id").alias("class_id"), "class_size")


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df without all but one of each class: the one with the smallest key (among those, the smallest text hash)."""
    _, found = _classes(df, key, text)
    best = found.filter("text_key = best.key").select("text_key", F.col("best.id").alias("__best"), F.col("best.rows").alias("__rows"))
    best = kept_table(best, "best")
    marked = df.withColumn("__key", _key(text_of(df[text])))
    kept = marked.join(best, (F.col("__key") == F.col("text_key")) & df[key].eqNullSafe(F.col("__best"))).select(
        *(df[c] for c in df.columns), "__key", "__rows"
    )
    once = kept.filter("__rows = 1")
    if best.filter("__rows > 1").head(1):  # rows that repeat in full
        once = once.union(kept.filter("__rows > 1").dropDuplicates(["__key"]))
    return once.drop("__key", "__rows")
