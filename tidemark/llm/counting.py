"""Token counts without tokens: byte pairs merged on a linked list, lowest rank first.

The symbols of a piece form a linked list; a heap holds every adjacent pair that has a rank. The lowest (rank, place)
is popped again and again; entries whose symbols have gone or changed are passed over. Each merge makes the list one
shorter, so the count is the initial symbols minus the merges, and no identifier is ever put out.

Special strings that stand in a text count one token each, as the tokenizers library has it by default. Null is an
empty text with no tokens. New columns take the place of columns of the same name; rows pass through one to one.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_column, strings, text_of
from tidemark.llm.splitting import Memo, lines_of

WORDS = 150_000
ID, PLACE = 24, 32
#: The split of the library's byte-level pre-tokenizer. Below the code point AGREED it is done by the regex module,
#: beyond by the library, whose Unicode tables are older.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
AGREED = "\u0530"


class Counter:
    """Counts for a byte-level BPE in the tokenizers library's file format."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        vocabulary, model = said["model"]["vocab"], said["model"]
        plain = all(not model.get(k) for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout", "ignore_merges"))
        kind = said["pre_tokenizer"] or {}
        exact = all(not (a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"]) for a in said["added_tokens"])
        if not plain or said["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not exact:
            raise ValueError(f"{path} is not a plain byte-level BPE")
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        # the byte alphabet: printable bytes stand for themselves, the others for the code points from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        other = iter(range(256, 512))
        self.symbol = [vocabulary[chr(b if b in shown else next(other))] for b in range(256)]
        self.pattern = regex.compile(SPLIT)
        self.ranks, self.joined = {}, []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocabulary[left] << ID | vocabulary[right]] = rank
            self.joined.append(vocabulary[left + right])
        names = sorted((a["content"] for a in said["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.marks = [n[:2] for n in names]
        self.pieces = Memo(self.count_piece, WORDS)
        self.after_blank = Memo(lambda word: self._plain(" " + word), WORDS)
        self.first = Memo(self._plain, WORDS)

    def count_piece(self, piece: str) -> int:
        symbols = [self.symbol[b] for b in piece.encode()]
        n, ranks, joined = len(symbols), self.ranks, self.joined
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pairs = [ranks.get(a << ID | b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]
        heap = [rank << PLACE | i for i, rank in enumerate(pairs) if rank >= 0]
        heapq.heapify(heap)
        count = n
        while heap:
            entry = heapq.heappop(heap)
            rank, i = entry >> PLACE, entry & (1 << PLACE) - 1
            if i >= len(pairs) or pairs[i] != rank:
                continue
            j = after[i]
            k = after[i] = after[j]
            symbol = symbols[i] = joined[rank]
            pairs[i] = -1
            if j < n - 1:
                pairs[j] = -1
            count -= 1
            if k < n:
                before[k] = i
                rank = pairs[i] = ranks.get(symbol << ID | symbols[k], -1)
                if rank >= 0:
                    heapq.heappush(heap, rank << PLACE | i)
            h = before[i]
            if h >= 0:
                rank = pairs[h] = ranks.get(symbols[h] << ID | symbol, -1)
                if rank >= 0:
                    heapq.heappush(heap, rank << PLACE | h)
        return count

    def _plain(self, text: str) -> int:
        if text and max(text) < AGREED:
            return sum(map(self.pieces.__getitem__, self.pattern.findall(text)))
        return sum(self.pieces[text[a:b]] for _, (a, b) in self.split(text))

    def _count(self, text: str) -> int:
        lines = lines_of(text) if text else []
        if lines is None:
            return self._plain(text)
        after = self.after_blank.__getitem__
        feeds = (len(lines) - 1) * self.first["\n"] if len(lines) > 1 else 0
        return feeds + sum(self.first[words[0]] + sum(map(after, words[1:])) for words in lines)

    def count(self, text: str) -> int:
        self.trim()
        if self.special is None or not any(mark in text for mark in self.marks):
            return self._count(text)
        parts = self.special.split(text)
        return sum(map(self._count, parts)) + len(parts) - 1

    def trim(self) -> None:
        for memo in (self.pieces, self.after_blank, self.first):
            memo.trim()


@lru_cache(maxsize=4)
def _counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(df: DataFrame, vocabulary: str, text: str = "text", limit: int = 512) -> DataFrame:
    """Adds n_bytes (UTF-8), n_tokens and over_limit (more tokens than limit)."""

    def run(batch: pa.Array) -> pa.Array:
        counter = _counter(vocabulary)
        return pa.array(list(map(counter.count, strings(batch))), pa.int64())

    whole = text_of(df[text])
    counted = df.withColumns(
        {"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": arrow_column(run, "long")(whole)}
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
