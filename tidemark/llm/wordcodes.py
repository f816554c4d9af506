"""Words of Arrow text columns as 64-bit numbers, many documents at a time and without a Python object per word.

Words are runs of bytes other than blank and U+0009 to U+000D. A word's number is a polynomial over a random value for
each byte, mixed with its length; words longer than LONG bytes are hashed by the library instead. Texts are taken in lots
of about LOT bytes, so what a task holds does not follow the batch; a longer text is a lot of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

LOT, LONG = 1 << 20, 4096
BLANK = 0x20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[BLANK, 9, 10, 11, 12, 13]] = False


class Words(NamedTuple):
    """data: the bytes of all texts; starts, ends: of each word; codes: its number; first: each text's first word, and the end."""

    data: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    codes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    return x ^ (x >> np.uint64(27))


def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A number for the sequence of what x and y stand for."""
    return mixed((x ^ (x >> np.uint64(32))) * _A + y)


def doubled(codes: np.ndarray, upto: int) -> Iterator[tuple[int, np.ndarray]]:
    """(k, numbers of the runs of k words that start at each place) for k = 1, 2, 4 .. upto; places too near the end are missing."""
    k, now = 1, codes
    while True:
        yield k, now
        if 2 * k > upto or len(now) <= k:
            return
        now, k = joined(now[: len(now) - k], now[k:]), 2 * k


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the runs of n words that start at each place."""
    out, at = None, 0
    if len(codes) < n or not n:
        return np.zeros(0, np.uint64)
    last = len(codes) - n + 1
    for k, numbers in doubled(codes, n):
        if n & k:
            part = numbers[at : at + last]
            out, at = (part if out is None else joined(out, part)), at + k
    return out


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(20240607))
    table = draw.integers(0, 2**64, 256, np.uint64)
    steps = np.full(LOT + 1, np.uint64(0xD1342543DE82EF95))
    steps[0] = 1
    return table, np.cumprod(steps)


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text or binary column without nulls."""
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32) if offsets else np.zeros(1, np.int64)
    ends = ends[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def lots(texts: pa.Array, limit: int = LOT) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about limit bytes each, one row at least."""
    _, offsets = _buffers(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, len(texts))
        at = to


def words_of(texts: pa.Array, other: np.ndarray | None = None) -> Words:
    """All words of a text column (null as empty). other: which bytes belong to words, by byte value."""
    data, offsets = _buffers(texts)
    inside = (_IS_WORD if other is None else other)[data]
    begins = np.empty(len(data) + 1, bool)
    begins[0], begins[1:] = True, ~inside
    begins[offsets] = True  # a word may start here, and ends here at the latest
    starts = np.flatnonzero(begins[:-1] & inside)
    ends = np.flatnonzero(inside & begins[1:] | inside & np.append(~inside[1:], True)) + 1 if len(data) else starts
    return Words(data, offsets, starts, ends, _codes(data, starts, ends), np.searchsorted(starts, offsets))


def _codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    import xxhash

    table, powers = _powers()
    codes, lengths, at = np.empty(len(starts), np.uint64), ends - starts, 0
    while at < len(starts):
        low = starts[at]
        to = int(np.searchsorted(ends, low + LOT, "right"))
        if to > at:
            part = data[low : ends[to - 1]]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(table[part] * powers[: len(part)], out=sums[1:])
            s, e = starts[at:to] - low, ends[at:to] - low
            codes[at:to] = mixed((sums[e] - sums[s]) * powers[LOT - s] + lengths[at:to].astype(np.uint64) * _A)
        at = max(to, at + 1)
    for i in np.flatnonzero(lengths > LONG):
        codes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return codes


def places(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """first[i] + 0 .. counts[i] - 1 for all i, one after another, and the i of each."""
    of = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(len(of)) - before[of] + first[of], of


def _covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in ranges that don't overlap."""
    steps = np.zeros(n + 1, np.int8)
    steps[starts] += 1
    steps[ends] -= 1
    return np.cumsum(steps[:-1], dtype=np.int8).view(bool)


def rejoined(words: Words, kept: np.ndarray) -> pa.Array:
    """Each text's kept words, joined by one blank, as a text column."""
    starts, ends = words.starts[kept], words.ends[kept]
    of = np.searchsorted(words.texts, starts, "right") - 1
    last = np.append(of[1:] != of[:-1], True) if len(of) else np.zeros(0, bool)
    lengths = ends - starts + ~last
    to = np.cumsum(lengths) - lengths
    offsets = np.append(to, lengths.sum())[np.searchsorted(of, np.arange(len(words.texts)))]
    out = np.full(int(offsets[-1]), BLANK, np.uint8)
    out[_covered(to, to + ends - starts, len(out))] = words.data[_covered(starts, ends, len(words.data))]
    wide = offsets[-1] >= 2**31
    kind, width = (pa.large_binary(), np.int64) if wide else (pa.binary(), np.int32)
    found = pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(out)])
    return found.cast(pa.large_string() if wide else pa.string())
