"""Token ids in files: one concatenated id array, with Elias-Fano coded document boundaries.

A file set is a Parquet folder with a row for each *segment*: a run of documents in ascending order of doc_id. The segment
itself is one binary value:

    "EFID"  width  documents  ids  low_bits    little-endian: 4 bytes, u8, u32, u64, u8
    nulls                                       u32: the first documents, whose doc_id is null
    doc_ids                                     Elias-Fano sequence, prefixed by the first doc_id (i64)
    boundaries                                  Elias-Fano sequence of documents + 1 offsets into the ids
    ids                                         u16 if every id of the segment is below 65536, else u32

An Elias-Fano sequence of n values up to u keeps the low bits of each packed, and the high parts as n ones among at most
u / 2^low zeros, so about 2 + log2(u / n) bits a value. Ones are found through a directory with the ones before each
block of 512 bits (u32). No 64-bit table of offsets is kept; where a segment begins in the whole array is the sum of the
ids before it, by shard and segment.

Texts are dealt out by ranges of doc_id, encoded by the tokenizers library where they land, and written; Spark commits
the files, so a lost executor's work is done again and replaced. Null texts are empty documents, which hold the end id
only. Null doc_ids come first. Rows with equal doc_id are documents of their own, in order of their texts. A document of
any length is in one segment. No rows give a folder that reads as no documents. Other columns are not written.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import strings, text_of
from tidemark.llm.splitting import Memo
from tidemark.session import scratch_dir

SEGMENT_IDS, SEGMENT_DOCS = 1 << 21, 1 << 15
BLOCK = 512
WORDS = 400_000
#: Texts whose new words go to the library together.
TEXTS = 512
#: Words that make one text for it.
LOT = 128
LAYOUT = "shard int, segment int, n_docs long, n_ids long, payload binary"


class EliasFano:
    """A sequence of ascending whole numbers from 0."""

    def __init__(self, n: int, low: int, lows: np.ndarray, highs: np.ndarray):
        self.n, self.low, self.lows, self.highs = n, low, lows, highs
        counts = np.bitwise_count(np.pad(highs, (0, -len(highs) % (BLOCK // 8))).reshape(-1, BLOCK // 8)).sum(axis=1)
        self.before = np.concatenate([[0], np.cumsum(counts)]).astype(np.uint32)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        most = int(values[-1]) if n else 0
        low = max(0, (most // n).bit_length() - 1) if n else 0
        shifts = np.arange(low, dtype=np.uint64)
        lows = np.packbits((values[:, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        bits[places] = 1
        return cls(n, low, lows, np.packbits(bits, bitorder="little"))

    def select(self, i: int) -> int:
        """The i-th value, from the block that holds its one."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        block = int(np.searchsorted(self.before, i, side="right")) - 1
        bits = np.unpackbits(self.highs[block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        place = block * BLOCK + int(np.flatnonzero(bits)[i - int(self.before[block])])
        first = i * self.low
        part = np.unpackbits(self.lows[first // 8 : (first + self.low + 7) // 8], bitorder="little")
        low = sum(int(b) << k for k, b in enumerate(part[first % 8 : first % 8 + self.low]))
        return (place - i) << self.low | low

    def values(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))
        bits = np.unpackbits(self.lows, bitorder="little", count=self.n * self.low).reshape(self.n, self.low)
        lows = (bits.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return ((places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)) | lows

    def to_bytes(self) -> bytes:
        return struct.pack("<IBQQ", self.n, self.low, len(self.lows), len(self.highs)) + self.lows.tobytes() + self.highs.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low, a, b = struct.unpack_from("<IBQQ", data, at)
        at += struct.calcsize("<IBQQ")
        lows = np.frombuffer(data, np.uint8, a, at)
        highs = np.frombuffer(data, np.uint8, b, at + a)
        return cls(n, low, lows, highs), at + a + b


class Segment:
    """What one payload holds."""

    def __init__(self, payload: bytes):
        data = memoryview(payload)
        magic, width, n_docs, n_ids, nulls, first = struct.unpack_from("<4sBIQIq", data)
        if magic != b"EFID":
            raise ValueError("not a segment")
        keys, at = EliasFano.read(data, struct.calcsize("<4sBIQIq"))
        self.boundaries, at = EliasFano.read(data, at)
        self.doc_ids = [None] * nulls + [first + int(k) for k in keys.values()]
        self.n_docs, self.ids = n_docs, np.frombuffer(data, f"<u{width}", n_ids, at)

    @staticmethod
    def pack(doc_ids: list[int | None], lengths: list[int], ids: bytes) -> bytes:
        """ids: all ids as little-endian u32."""
        known = [d for d in doc_ids if d is not None]
        first = known[0] if known else 0
        values = np.frombuffer(ids, "<u4")
        width = 2 if not len(values) or int(values.max()) < 1 << 16 else 4
        head = struct.pack("<4sBIQIq", b"EFID", width, len(doc_ids), len(values), len(doc_ids) - len(known), first)
        keys = EliasFano.of(np.array([d - first for d in known], np.uint64))
        offsets = EliasFano.of(np.concatenate([[0], np.cumsum(lengths)]))
        return head + keys.to_bytes() + offsets.to_bytes() + values.astype(f"<u{width}").tobytes()

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.boundaries.select(i) : self.boundaries.select(i + 1)]


class Pieces:
    """Ids of words of Latin-1 letters, digits and signs, by the model of the library's tokenizer alone.

    Serves tokenizers whose steps before the model are those of STEPS: on such a word the first changes letter cases
    only, and the second cuts it by the pattern, which skips nothing. Pieces are shared by many words ("end", "End,"
    and "end."), are remembered, and skip the library's own normaliser and pattern, which cost more than the model.
    """

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    STEPS = (
        ["NFC", ("Replace", r"\s+", " "), "Lowercase"],
        [("Split", PATTERN, "Removed", True), ("ByteLevel", False, False)],
    )
    LATIN = re.compile("[^\x00-\x20\x7f-\xa0\u0100-\U0010ffff]+")

    def __init__(self, tokenizer):
        import regex
        from tokenizers.pre_tokenizers import ByteLevel

        self.find = regex.compile(self.PATTERN).findall
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {code: spell(chr(code))[0][0] for code in range(0xA1, 0x100)}
        self.tokenize = tokenizer.model.tokenize
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.known = Memo(self._of_piece, WORDS)

    @classmethod
    def serves(cls, tokenizer) -> bool:
        """Whether the steps before the model are those that this class stands for."""
        given = json.loads(tokenizer.to_str())
        normalizer, pre = given["normalizer"] or {}, given["pre_tokenizer"] or {}
        first = [
            (n["type"], n["pattern"].get("Regex"), n["content"]) if n["type"] == "Replace" else n["type"]
            for n in normalizer.get("normalizers", ())
        ]
        second = [
            (n["type"], n["pattern"].get("Regex"), n["behavior"], n["invert"])
            if n["type"] == "Split"
            else (n["type"], n.get("add_prefix_space"), n.get("use_regex"))
            for n in pre.get("pretokenizers", ())
        ]
        return (first, second) == cls.STEPS

    def _of_piece(self, piece: str) -> bytes:
        spelt = piece if piece.isascii() else piece.translate(self.spelling)
        return array("I", [token.id for token in self.tokenize(spelt)]).tobytes()

    def of(self, word: str) -> bytes | None:
        """The word's ids, or None where the whole tokenizer must be asked."""
        if not self.LATIN.fullmatch(word) or any(s in word for s in self.special):
            return None
        low = word.lower()
        if low.isalpha():
            return self.known[low]
        return b"".join([self.known[piece] for piece in self.find(low)])


class Encoder:
    """Ids of whole texts, by the tokenizers library.

    The vocabulary's own pre-tokenizer drops white space and no step of it looks across, so a text's ids are its words'
    ids in order. Words that were seen since the memory was last full, or in the time before, are looked up;
    the others go to the model by pieces, or else those of a batch to the library together. A vocabulary that keeps white space, or a text with white space on which Python and the library differ, is encoded whole.
    """

    UNSURE = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.end, self.known = Tokenizer.from_file(path), struct.pack("<I", end), {}
        self.older: dict[str, bytes] = {}
        self.whole = self._ids(["a  b c\td\ne"])[0] != b"".join(self._ids(["a", "b", "c", "d", "e"]))
        special = [(t.content, number) for number, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.mark = special[-1] if special else None
        self.pieces = Pieces(self.tokenizer) if Pieces.serves(self.tokenizer) else None
        self.single = Memo(self._of_word, WORDS)

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _of_words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words with their ids, from one text of them all, between strings of the special token that ends a text."""
        if self.mark is None or any(self.mark[0] in word for word in words):
            yield from zip(words, self._ids(words), strict=True)
            return
        found = self.tokenizer.encode_batch_fast([self.mark[0].join(words)], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<u4")
        ends, raw, at = [*(4 * np.flatnonzero(ids == self.mark[1])).tolist(), 4 * len(ids)], ids.tobytes(), 0
        for word, end in zip(words, ends, strict=True):
            yield word, raw[at:end]
            at = end + 4

    def _of_word(self, word: str) -> bytes:
        ids = self.pieces.of(word)
        return self._ids([word])[0] if ids is None else ids

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.whole:
            return [ids + self.end for ids in self._ids(texts)]
        if self.pieces is not None:
            self.single.trim()
            self.pieces.known.trim()
            known = self.single.__getitem__
            return [
                (self._ids([t])[0] if self.UNSURE.search(t) else b"".join(map(known, t.split()))) + self.end for t in texts
            ]
        words = [None if self.UNSURE.search(t) else t.split() for t in texts]
        if len(self.known) > WORDS:
            self.older, self.known = self.known, {}
        new = set().union(*(w for w in words if w)) - self.known.keys()
        again = new & self.older.keys()
        self.known.update((word, self.older[word]) for word in again)
        new = list(new - again)
        for at in range(0, len(new), LOT):
            self.known.update(self._of_words(new[at : at + LOT]))
        known = self.known.__getitem__
        return [
            (self._ids([t])[0] if w is None else b"".join(map(known, w))) + self.end
            for t, w in zip(texts, words, strict=True)
        ]


@lru_cache(maxsize=2)
def _encoder(path: str, end: int) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, end)


def write_ids(df: DataFrame, vocabulary: str, path: str, end: int = 1, key: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of all texts, each with the end id, to a new folder."""
    docs = df.select(df[key].cast("long").alias("doc_id"), text_of(df[text]).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    ranged = docs.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(*order)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, encoder = TaskContext.get().partitionId(), _encoder(vocabulary, end)
        keys, lengths, parts, size, number = [], [], [], 0, 0

        def out() -> pa.RecordBatch:
            payload = Segment.pack(keys, lengths, b"".join(parts))
            columns = [[shard], [number], [len(keys)], [sum(lengths)], [payload]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in LAYOUT.split(", ")]
            )

        for batch in batches:
            some = (list(strings(batch["text"].slice(at, TEXTS))) for at in range(0, len(batch), TEXTS))
            coded = (ids for texts in some for ids in encoder.encode(texts))
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), coded, strict=True):
                keys.append(doc_id)
                lengths.append(len(ids) // 4)
                parts.append(ids)
                size += len(ids) // 4
                if size >= SEGMENT_IDS or len(keys) >= SEGMENT_DOCS:
                    yield out()
                    keys, lengths, parts, size, number = [], [], [], 0, number + 1
        if keys:
            yield out()

    ranged.mapInArrow(segments, LAYOUT).write.parquet(path)


def read_ids(spark: SparkSession, path: str, checksums: bool = False) -> DataFrame:
    """doc_id, start (in the whole array), n_tokens, and ids of every document.

    With checksums, ids_crc32 (unsigned, of the ids as little-endian u32) stands in place of ids.
    """
    files = spark.read.schema(LAYOUT).parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("size"))  # as many rows as the writing tasks
    first = F.coalesce(F.sum("size").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = shards.select("shard", first.alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("shard", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("before"))
    starts = starts.join(shards, "shard").select(
        F.col("shard").alias("of"), F.col("segment").alias("nr"), (F.col("shard_start") + F.col("before")).alias("base")
    )
    last = "ids_crc32" if checksums else "ids"
    layout = f"shard int, segment int, doc_id long, start long, n_tokens long, {last} {'long' if checksums else 'array<int>'}"

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in layout.split(", ")]
        for batch in batches:
            for shard, number, payload in zip(*(batch[c].to_pylist() for c in ("shard", "segment", "payload")), strict=True):
                segment = Segment(payload)
                n = segment.n_docs
                for a in range(0, n, 1024):
                    b = min(n, a + 1024)
                    places = np.array([segment.boundaries.select(i) for i in range(a, b + 1)], np.int64)
                    ids = segment.ids[places[0] : places[-1]]
                    cuts = (places - places[0]).astype(np.int32)
                    if checksums:
                        wide = ids.astype("<u4")
                        said = pa.array([zlib.crc32(wide[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)], pa.int64())
                    else:
                        said = pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids.astype(np.int32)))
                    arrays = [
                        pa.array([shard] * (b - a), pa.int32()), pa.array([number] * (b - a), pa.int32()),
                        pa.array(segment.doc_ids[a:b], pa.int64()), pa.array(places[:-1]), pa.array(np.diff(places)), said,
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    found = files.select("shard", "segment", "payload").mapInArrow(documents, layout)
    joined = found.join(starts, (F.col("shard") == F.col("of")) & (F.col("segment") == F.col("nr")))
    return joined.select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", last)


def fresh_folder(spark: SparkSession, name: str = "ids") -> str:
    return scratch_dir(spark, name)
