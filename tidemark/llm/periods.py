"""Runs: maximal periodic stretches of words, found with string synchronising sets.

A run is a stretch of words with smallest period q, at least 2 q and least words long, that no neighbouring word extends.
Texts are worked on in lots, laid one after another with a separator of its own behind each, so no run crosses texts.

* Periods below 12 are read off directly: words that equal the word q before, in sequence.
* At each scale t = 4, 8, 16 .. the set S holds the places i where the least hash of the t-word windows that start at
  i .. i + t is that of the first or of the last. Windows with a period of t / 3 or less have no hash; runs of smaller
  scales tell where these are. Whether i is in S depends on the 2 t words from i only, so equal contexts are chosen alike,
  and 3 t - 1 words without a place of S have a period of t / 3 or less.
* A run with a period q from 3 t to 6 t repeats at least 3 t words after q words. If these are not highly periodic, a place
  of S lies among them, and q further on another one with the same context: pairs of places with equal contexts, 3 t to
  6 t apart, propose their distance. Contexts that are equal and nearer than t / 3 don't exist, so there are few.
* If they are highly periodic, with period p, a run of period p ends where another one with the same root, in another phase,
  begins. The places where such runs touch propose all distances that bring the phases together.
* A proposed distance is extended to both sides by comparing hashes of 2^k words. Of equal stretches the smallest period stays.

Words and windows are compared by 64-bit hashes. What a lot holds is some numbers for each word, not more for a long text; a
text must fit a task. Null and empty texts have no words and no runs, like texts shorter than least. Repeated rows are
documents of their own; an empty table gives an empty result. New columns take the place of columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm.common import arrow_column, text_of
from tidemark.llm.wordcodes import joined, lots, mixed, rejoined, words_of

LEAST = 12
DIRECT = 12
#: Numbers of 2^k words are kept up to this k for extending; longer stretches are compared in steps of 2^TOP words.
TOP = 10
_NONE = np.uint64(2**64 - 1)


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each sequence of true values."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at
    cut = np.flatnonzero(np.diff(at) > 1)
    return at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + 1


def _first_of_each(runs: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) in this order, with the smallest period of each stretch."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[np.append(True, (np.diff(runs[:, :2], axis=0) != 0).any(axis=1))] if len(runs) else runs


def _direct(words: np.ndarray, least: int) -> np.ndarray:
    """Runs with periods below DIRECT; short ones too if they are three periods long, for the scales."""
    found = [np.zeros((0, 3), np.int64)]
    for q in range(1, min(DIRECT, len(words) // 2 + 1)):
        start, end = _stretches(words[q:] == words[:-q])
        long = end - start + q >= min(max(least, 2 * q), max(4, 3 * q))
        found.append(np.stack([start[long], end[long] + q, np.full(long.sum(), q)], 1))
    return _first_of_each(np.concatenate(found))


def _extended(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many words from i on equal those from j on (i < j), and how many before i equal those before j."""
    ahead, behind = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    for far, forward in ((ahead, True), (behind, False)):
        going = np.arange(len(i))
        k = len(levels) - 1
        while k >= 0 and len(going):
            size, level = 1 << k, levels[k]
            a = i[going] + far[going] if forward else i[going] - far[going] - size
            b = j[going] + far[going] if forward else j[going] - far[going] - size
            fits = (b + size <= n) if forward else (a >= 0)
            same = np.zeros(len(going), bool)
            same[fits] = level[a[fits]] == level[b[fits]]
            far[going[same]] += size
            if k == len(levels) - 1 and same.any():
                going = going[same]  # once more in steps of this size
                continue
            if k == len(levels) - 1:
                going = np.arange(len(i))
            k -= 1
    return ahead, behind


def _checked(levels: list[np.ndarray], i: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
    """The maximal stretches around i whose words equal those q further on, if two periods long."""
    ahead, behind = _extended(levels, i, i + q, n)
    found = np.stack([i - behind, i + q + ahead, q], 1)
    return found[ahead + behind >= q]


def _synchronised(numbers: np.ndarray, periodic: np.ndarray, t: int) -> np.ndarray:
    """The places of S at scale t; numbers: of the windows of t words, periodic: which of them have none."""
    ids = np.where(periodic, _NONE, mixed(numbers))
    least, span = ids, 1
    while 2 * span <= t:
        least, span = np.minimum(least[: len(least) - span], least[span:]), 2 * span
    least = np.minimum(least[:-1], ids[span:][: len(least) - 1]) if len(least) > 1 else least[:0]
    here, there = ids[: len(least)], ids[t : t + len(least)]
    return np.flatnonzero(((least == here) | (least == there)) & (least != _NONE))


def _pairs(chosen: np.ndarray, contexts: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of S with equal contexts, 3 t to 6 t apart: the first of the two, and the distance."""
    order = np.argsort(contexts, kind="stable")
    keys, at = contexts[order], chosen[order]
    left, gaps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    first, step = np.arange(len(at) - 1), 1
    while len(first):
        near = (keys[first + step] == keys[first]) & (at[first + step] - at[first] < 6 * t)
        first = first[near]
        gap = at[first + step] - at[first]
        left.append(at[first[gap >= 3 * t]])
        gaps.append(gap[gap >= 3 * t])
        step += 1
        first = first[first + step < len(at)]
    return np.concatenate(left), np.concatenate(gaps)


def _touching(words: np.ndarray, runs: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances from 3 t to 6 t that bring two touching runs of one small period into phase, with a place each."""
    small = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= 3 * t)]
    small = small[np.lexsort((small[:, 0], small[:, 2]))]
    a, b = small[:-1], small[1:]
    meet = (a[:, 2] == b[:, 2]) & (b[:, 0] <= a[:, 1])
    left, gaps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for (begin, end, p), (start, stop, _) in zip(a[meet].tolist(), b[meet].tolist(), strict=True):
        root, hay = words[start : start + p].tobytes(), words[begin : begin + 2 * p].tobytes()
        at = hay.find(root)
        while at > 0 and at % 8:
            at = hay.find(root, at + 1)
        if at < 0:
            continue  # another root
        phase = (start - begin - at // 8) % p
        q = np.arange(3 * t + (phase - 3 * t) % p, min(6 * t, end - begin + 1, stop - start + 1), p)
        left.append(end - q)
        gaps.append(q)
    return np.concatenate(left), np.concatenate(gaps)


def runs_of(words: np.ndarray, longest: int, least: int = LEAST) -> np.ndarray:
    """All runs of a sequence of words (64-bit numbers), as rows (start, end, period) in this order.

    longest bounds the length of a run from above.
    """
    n, runs = len(words), _direct(words, least)
    if longest < 2 * DIRECT:
        return runs[runs[:, 1] - runs[:, 0] >= np.maximum(least, 2 * runs[:, 2])]
    levels = [words]
    while len(levels) <= TOP and len(levels[-1]) > 1 << len(levels) - 1:
        half = 1 << len(levels) - 1
        levels.append(joined(levels[-1][: len(levels[-1]) - half], levels[-1][half:]))
    t, numbers = 4, levels[2]
    while 6 * t <= longest:
        wide = joined(numbers[: len(numbers) - t], numbers[t:])
        small = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= t)]
        edges = np.zeros(len(numbers) + 1, np.int32)
        np.add.at(edges, small[:, 0], 1)
        np.add.at(edges, small[:, 1] - t + 1, -1)
        chosen = _synchronised(numbers, np.cumsum(edges[:-1]) > 0, t)
        chosen = chosen[chosen < len(wide)]
        i, q = _pairs(chosen, wide[chosen], t)
        j, more = _touching(words, runs, t)
        found = _checked(levels, np.append(i, j), np.append(q, more), n)
        if len(found):
            runs = _first_of_each(np.concatenate([runs, found]))
        t, numbers = 2 * t, wide
    return runs[runs[:, 1] - runs[:, 0] >= np.maximum(least, 2 * runs[:, 2])]


def _lot(texts: pa.Array, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    words = words_of(texts)
    counts = words.counts()
    shift = np.repeat(np.arange(len(counts)), counts)
    line = mixed(np.arange(len(words.codes) + len(counts), dtype=np.uint64) + np.uint64(0x51ED270B_00000000))
    line[np.arange(len(words.codes)) + shift] = words.codes
    found = runs_of(line, int(counts.max(initial=0)), least)
    of = np.searchsorted(words.first[1:] + np.arange(len(counts)), found[:, 0], "right")
    found[:, :2] -= of[:, None]
    steps = np.zeros(len(words.codes) + 1, np.int64)
    np.add.at(steps, found[:, 0] + found[:, 2], 1)
    np.add.at(steps, found[:, 1], -1)
    kept = np.cumsum(steps[:-1]) == 0
    start = found[:, 0] - words.first[of]
    order = np.lexsort((found[:, 2], start, of))
    fields = [pa.array(x[order], pa.int64()) for x in (start, found[:, 1] - found[:, 0], found[:, 2])]
    offsets = np.append(0, np.cumsum(np.bincount(of, minlength=len(counts)))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, names=["start", "length", "period"]))
    return pa.array(counts, pa.int64()), lists, rejoined(words, kept)


def _of_batch(texts: pa.Array, least: int) -> pa.Array:
    """Lots hold texts of like length, since the longest decides how many scales a lot takes."""
    order = np.argsort(pc.binary_length(texts).fill_null(0).to_numpy(), kind="stable")
    texts, parts = texts.take(pa.array(order)), []
    for i, j in lots(texts):
        parts.append(_lot(texts.slice(i, j - i), least))
    if not parts:
        return pa.array([], pa.struct([("n_words", pa.int64()), ("runs", _RUNS), ("collapsed", pa.string())]))
    back = pa.array(np.argsort(order))
    columns = [pa.concat_arrays([c.cast(pa.string()) if pa.types.is_large_string(c.type) else c for c in part]).take(back) for part in zip(*parts, strict=True)]
    return pa.StructArray.from_arrays(columns, names=["n_words", "runs", "collapsed"])


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def with_runs(df: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """df with n_words, runs (start, length and period, in this order) and collapsed.

    collapsed is the text without what a run repeats, that is without the words after its first period, joined by one blank.
    """
    kind = "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"
    columns = [c for c in df.columns if c.lower() not in ("n_words", "runs", "collapsed")]
    found = arrow_column(lambda batch: _of_batch(batch, least), kind)
    return df.select(*columns, found(text_of(df[text])).alias("__found")).select(*columns, "__found.*")
