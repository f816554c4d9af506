"""Byte-level BPE, token counts and id files, against the public libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bytebpe, counting, idfiles, splitting

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    None, "", " ", "\n\n  a", "a  b\t\tc \n", "it's We'LL 12345 ½ x²", "été naïve 字漢 😀👩‍👩‍👧 \u0301a", "a" * 5000, "<|endoftext|>x <|endoftext|>",
    "\x00\x1c\x85\u2028 z", "word " * 3000, "ŸΣΣ İstanbul ǅ", "ab3.,!? 's 'T", "\r\nline\r\n",
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=bytebpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame([(10_000 + i, t, i, "x") for i, t in enumerate(ODD + ODD)], "doc_id long, text string, ids int, Decoded string")
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "text", "1 AS ids", "'x' AS Decoded")
    return odd.union(given)


def test_encode_as_library_and_decode(docs, library):
    made = bytebpe.encode(docs, RANKS, PATTERN)
    assert made.columns == ["doc_id", "text", "ids", "Decoded"]  # a column of the name is replaced
    found = bytebpe.decode(made, RANKS).collect()
    assert len(found) == docs.count()
    for row in found:
        assert row["ids"] == library.encode_ordinary(row["text"] or "")
        assert row["decoded"] == (row["text"] or "")
    both = bytebpe.encode(docs, RANKS, PATTERN, decoded="back")
    assert both.where("back <> coalesce(text, '')").count() == 0


def test_digests_of_the_query(spark, library):
    from tidemark.llm.queries import byte_bpe

    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for row in byte_bpe(spark, "/root/testdata/sf0.001").collect():
        ids = library.encode_ordinary(text[row["doc_id"]])
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert tuple(row)[1:] == (len(ids), sha(",".join(map(str, ids))), sha(text[row["doc_id"]]))


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bytebpe.decode(bytebpe.encode(none, RANKS, PATTERN), RANKS).count() == 0
    assert counting.count_tokens(none, BYTES).count() == 0
    idfiles.write_ids(none, WORDS, str(tmp_path / "ids"))
    assert idfiles.read_ids(spark, str(tmp_path / "ids")).count() == 0


def test_transducer_forgets_and_emits_early(library):
    small = bytebpe.Transducer(bytebpe.read_ranks(RANKS), limit=50)
    draw = random.Random(5)
    for _ in range(300):
        piece = "".join(draw.choice("abetion éß") for _ in range(draw.choice([3, 12, 40])))
        assert small.encode(piece.encode()) == library._core_bpe.encode_single_piece(piece.encode())
    long = ("ationabcd" * 2000).encode()
    assert small.encode(long) == library._core_bpe.encode_single_piece(long)


def test_new_words_take_no_steps_one_by_one(library, monkeypatch):
    """op2 and pipeline: words that occur once are encoded side by side; only long pieces go through states."""
    encoder, moves = bytebpe.Encoder(bytebpe.read_ranks(RANKS), PATTERN), []
    move = bytebpe.Transducer._move
    monkeypatch.setattr(bytebpe.Transducer, "_move", lambda *a: moves.append(1) or move(*a))
    monkeypatch.setattr(bytebpe, "LOT", 1 << 9)
    draw = random.Random(6)
    texts = []
    for _ in range(60):
        words = ["".join(draw.choice("abetionrs éß字'3,😀") for _ in range(draw.choice([1, 7, 12, 40]))) for _ in range(40)]
        texts.append("".join(w + draw.choice([" ", " ", "\n"]) for w in words))
    texts = [*texts, *(t.strip() for t in texts), *ODD[:7], *ODD[8:], "a\u3000b", "a\xa0 b", "\u201ca\u201d \u2014 b\u2019s c", " a", "a ", "a \nb"]
    for part in (pa.array(texts), pa.array(texts).slice(5, 70), pa.array([None, ""], pa.string()), pa.array([], pa.string())):
        assert encoder.encode(part).to_pylist() == [library.encode_ordinary(t or "") for t in part.to_pylist()]
    assert not moves
    assert encoder.encode(pa.array(["a" * 5000])).to_pylist() == [library.encode_ordinary("a" * 5000)] and moves


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n\t\x1c\x85\xa0\u2009\u200b\u2028\u3000é字"), max_size=8) | st.none()))
def test_chunks_as_lines_of_words(texts):
    chunks, first = splitting.chunks_of(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, first[:-1], first[1:], strict=True):
        lines = splitting.lines_of(text) if text else []
        expected = [text] if lines is None else [w for i, line in enumerate(lines) for w in ["\n"] * (i > 0) + [line[0], *(f" {w}" for w in line[1:])]]
        assert chunks.slice(a, b - a).to_pylist() == expected


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40), st.integers(1, 5))
def test_utf8_machine(data, step):
    machine = bytebpe.Utf8()
    parts = [machine.feed(data[i : i + step]) for i in range(0, len(data), step)]
    assert "".join(parts) + machine.end() == data.decode("utf-8", "replace")


def test_decode_cut_characters(spark):
    ranks = bytebpe.read_ranks(RANKS)
    euro = [ranks[bytes([b])] for b in "€".encode()]
    rows = spark.createDataFrame([(euro,), (euro[:2],), (None,), ([euro[0], None, *euro[1:]],)], "ids array<int>")
    assert [r["text"] for r in bytebpe.decode(rows, RANKS, text="text").collect()] == ["€", "\ufffd", "", "€"]


def test_counts_as_library(docs):
    library = Tokenizer.from_file(BYTES)
    for row in counting.count_tokens(docs, BYTES, limit=100).collect():
        text = row["text"] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(text.encode()), n, n > 100)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**40), min_size=1, max_size=300).map(sorted))
def test_elias_fano(values):
    made = idfiles.EliasFano.of(np.array(values, np.uint64))
    read, _ = idfiles.EliasFano.read(memoryview(made.to_bytes()), 0)
    assert read.values().tolist() == values
    assert [read.select(i) for i in range(0, len(values), 7)] == values[::7]
    bits = 8 * (len(read.lows) + len(read.highs))
    assert bits <= len(values) * (3 + max(0, (values[-1] // len(values)).bit_length())) + 16


def test_id_files(spark, docs, tmp_path):
    ties = spark.createDataFrame([(None, "none"), (None, None), (3, "b"), (3, "a"), (-9, "minus"), (2**62, "large")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(ties)
    path = str(tmp_path / "ids")
    idfiles.write_ids(rows.repartition(5), WORDS, path)
    library = Tokenizer.from_file(WORDS)
    order = sorted(((r["doc_id"], r["text"] or "") for r in rows.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    expected, start = [], 0
    for doc_id, text in order:
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        expected.append((doc_id, start, len(ids), ids))
        start += len(ids)
    by = lambda x: (x[1], x[2])
    found = sorted((tuple(r) for r in idfiles.read_ids(spark, path).collect()), key=by)
    assert found == expected
    sums = sorted((tuple(r) for r in idfiles.read_ids(spark, path, checksums=True).collect()), key=by)
    assert sums == [(d, s, n, zlib.crc32(np.array(ids, "<u4").tobytes())) for d, s, n, ids in expected]
    payload = spark.read.parquet(path).first()["payload"]
    segment = idfiles.Segment(bytes(payload))
    assert segment.document(0).tolist() in [e[3] for e in expected]


def test_ids_by_pieces_are_the_librarys():
    """Words of Latin-1 go to the model by pieces: signs, contractions, special strings, controls and what falls outside."""
    tokenizer, encoder = Tokenizer.from_file(WORDS), idfiles.Encoder(WORDS, 1)
    assert encoder.pieces is not None
    draw = random.Random(3)
    signs = [chr(c) for c in range(1, 0x250)] + list("'sstremvld<|>endoftext ") * 6
    signs += ["<|endoftext|>", "<|startoftext|>", "́", "K", "'S", "'LL", " ", "é"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(30))) for _ in range(5000)] + ["", "x" * 100_000]
    found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert encoder.encode(texts) == [np.array([*e.ids, 1], "<u4").tobytes() for e in found]


def test_another_tokenizer_takes_the_general_way():
    assert not idfiles.Pieces.serves(Tokenizer.from_file(BYTES))
