"""Cuts texts into chunks that byte-level tokenizers treat independently.

The public split pattern joins one blank to the word that follows it and keeps other white space apart. A text
whose white space is single blanks and single line feeds between words therefore falls into words that are told
apart only by what stands before them: a blank, or the start of a line. Such words are looked up whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

import numpy as np
import pyarrow as pa

from tidemark.llm.wordcodes import _buffers

#: White space beside blank and line feed, as str.split() has it: by byte, and in more than one byte with its first bytes.
_WIDE = tuple(c.encode() for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))))
_ODD, _LEAD = np.zeros(256, bool), np.zeros(256, bool)
_ODD[[9, 11, 12, 13, 28, 29, 30, 31]] = True
_LEAD[[c[0] for c in _WIDE]] = True


def lines_of(text: str) -> list[list[str]] | None:
    """Words by line if all white space is single, else None."""
    words = text.split()
    gaps = len(words) - 1
    if text.count(" ") + text.count("\n") != gaps or len("".join(words)) + gaps != len(text):
        return None
    return [line.split(" ") for line in text.split("\n")]


def chunks_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The chunks of a text column (null as empty), and each text's first chunk, and the end.

    A text for which lines_of tells words is cut before every blank and around every line feed; any other is one chunk.
    """
    data, offsets = _buffers(texts)
    white = (data == 0x20) | (data == 0x0A)
    odd = (data < 0x20) & _ODD[data]
    lead = np.flatnonzero(_LEAD[data])
    odd[lead[[data[i : i + 3].tobytes().startswith(_WIDE) for i in lead]]] = True
    odd[1:] |= white[1:] & white[:-1]
    some = offsets[:-1] < offsets[1:]
    for at in (offsets[:-1][some], offsets[1:][some] - 1):
        odd[at] |= white[at]
    plain = np.ones(len(texts), bool)
    plain[np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1] = False
    cuts = np.append(white & np.repeat(plain, np.diff(offsets)), True)
    cuts[1:] |= cuts[:-1] & (data == 0x0A)
    cuts[offsets] = True
    cuts = np.flatnonzero(cuts)
    chunks = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data)))
    return chunks, np.searchsorted(cuts, offsets)


class Memo(dict):
    """Remembers a function's results: those since the last trim() that found it full, and those of the time before."""

    def __init__(self, function: Callable[[str], Any], limit: int):
        self.function, self.limit, self.older = function, limit, {}

    def __missing__(self, key: str) -> Any:
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        self[key] = value
        return value

    def unknown(self, keys: Iterable[str]) -> list[str]:
        """Those whose results are not remembered."""
        older = self.older
        return [key for key in keys if key not in self and key not in older]

    def trim(self) -> None:
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
