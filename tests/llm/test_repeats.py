"""Repeated passages, periodic runs and phrases, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import periods, phrases, substrings

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall((text or "").encode())


def without_repeats(texts, window):
    """Plain: every window's words as a tuple, counted."""
    split = [words_of(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), b" ".join(kept).decode()))
    return out


def passages(seed, n=220):
    draw = random.Random(seed)
    prose = lambda k, v=300: [f"w{draw.randint(0, v)}" for _ in range(k)]
    shared = [prose(draw.choice([20, 34, 35, 36, 60, 150])) for _ in range(12)]
    texts = []
    for _ in range(n):
        words = prose(draw.randint(0, 120))
        for _ in range(draw.randint(0, 3)):
            part = draw.choice(shared)
            a = draw.randint(0, len(part) // 2)
            words[draw.randint(0, len(words)) :] = part[a : a + draw.randint(1, len(part))] + prose(draw.randint(0, 60))
        texts.append(draw.choice([" ", "\n", " \t "]).join(words))
    base = prose(200)
    for i in range(40):  # copies, each changed in its own way
        copy = list(base)
        for _ in range(i % 4):
            copy[draw.randrange(200)] = f"new{i}"
        texts.append(" ".join(copy))
    texts += ["a " * 34, "a " * 35, "a " * 36, "a b " * 40, "x y z " * 13, " ".join(prose(30, 3) * 5), " ".join(prose(4000, 2)), None, "", "  \n", "é " * 50]
    return texts + texts[5:9] + [texts[230]] * 5


@pytest.mark.parametrize(("seed", "window", "mer"), [(1, 35, 16), (2, 35, 16), (3, 12, 5), (4, 6, 6)])
def test_repeated_windows_are_removed(spark, seed, window, mer):
    texts = passages(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    df = df.withColumn("Kept", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("edge", F.lit("x"))
    made = substrings.remove_repeats(df, window=window, mer=mer)
    assert made.columns == ["doc_id", "text", "row", "edge", "n_words", "n_removed", "kept"]
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in made.collect()}
    assert found == dict(enumerate(without_repeats(texts, window)))


def test_repeats_of_odd_tables(spark):
    long = " ".join(f"u{i}" for i in range(300_000))
    rows = [(None, "a b c " * 20), (None, "a b c " * 20), (1, None), (1, None), (2, long), (3, "z " + long.split(" ", 200_000)[-1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["n_words"], r["n_removed"]) for r in substrings.remove_repeats(df).collect())
    assert found == [(0, 0), (0, 0), (60, 60), (60, 60), (100_001, 100_000), (300_000, 100_000)]
    assert substrings.remove_repeats(df.limit(0)).count() == 0


def test_repeats_of_the_query(spark):
    from tidemark.llm.queries import substring_dedup

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    plain = {d["doc_id"]: w for d, w in zip(docs, without_repeats([d["text"] for d in docs], 35), strict=True)}
    for row in substring_dedup(spark, folder).collect():
        n, removed, kept = plain[row["doc_id"]]
        assert tuple(row)[1:] == (n, removed, hashlib.sha256(kept.encode()).hexdigest())


def runs_of(words, least=12):
    """Plain: for each period, stretches of words that equal the one a period before; the smallest period of each."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def periodic(draw, k):
    kind = draw.randrange(6)
    if kind == 0:
        return [draw.choice("ab") for _ in range(draw.randint(0, k))]
    if kind == 1:  # runs that touch
        root, words = [draw.choice("ab") for _ in range(draw.randint(1, 4))], []
        while len(words) < k:
            words += (root * draw.randint(1, 30))[draw.randint(0, 2) :] + [draw.choice("abc")] * draw.randint(0, 2)
        return words
    if kind == 2:  # a period that is highly periodic in itself
        p = draw.randint(2, 5)
        half = ([draw.choice("ab") for _ in range(p)] * k)[: draw.randint(9 * p, k // 3 + 9 * p)]
        return [draw.choice("abc")] * draw.randint(0, 20) + half * 2 + half[: draw.randint(0, len(half))] + ["c"]
    if kind == 3:
        a, b = "a", "ab"
        while len(b) < k:
            a, b = b, b + a
        return list(b[:k])
    root = [str(draw.randint(0, 9)) for _ in range(draw.randint(1, k // 2 + 1))]
    ends = [[str(draw.randint(0, 9)) for _ in range(draw.randint(0, k // 2))] for _ in range(2)]
    return ends[0] + (root * 20)[: draw.randint(1, k)] + ends[1]


def test_runs_as_brute_force():
    import pyarrow as pa

    draw = random.Random(21)
    for _ in range(120):
        docs = [periodic(draw, draw.choice([20, 60, 200, 300])) for _ in range(draw.randint(1, 8))]
        texts = pa.array([" ".join(d) if d else None for d in docs], pa.string())
        for words, row in zip(docs, periods._of_batch(texts, 12).to_pylist(), strict=True):
            wanted = runs_of(words)
            assert [tuple(r.values()) for r in row["runs"]] == wanted
            gone = {i for s, n, q in wanted for i in range(s + q, s + n)}
            assert row["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_odd_tables(spark):
    rows = [(1, None), (2, ""), (3, "a " * 500_000), (3, "a " * 500_000), (None, "x y\n" * 6), (4, "a b c d e f"), (5, " ".join(map(str, range(300_000))))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Runs", F.lit(0)).withColumn("start", F.lit(7))
    made = periods.with_runs(df)
    assert made.columns == ["doc_id", "text", "start", "n_words", "runs", "collapsed"]
    found = Counter((r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"][:20]) for r in made.collect())
    assert found == {
        (0, (), ""): 2, (500_000, ((0, 500_000, 1),), "a"): 2, (12, ((0, 12, 2),), "x y"): 1, (6, (), "a b c d e f"): 1,
        (300_000, (), "0 1 2 3 4 5 6 7 8 9 "): 1,
    }
    assert periods.with_runs(df.limit(0)).count() == 0


def test_runs_of_the_query(spark):
    from tidemark.llm.queries import periodic_runs

    folder, lines = "/root/testdata/sf0.001", {}
    for d in spark.read.parquet(f"{folder}/documents.parquet").collect():
        words, h = words_of(d["text"]), zlib.crc32(str(d["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = runs_of(words) if n < 3000 else []
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        gone = {i for s, k, q in runs for i in range(s + q, s + k)}
        sha = lambda x: hashlib.sha256(x).hexdigest()
        listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        lines[d["doc_id"]] = n, (len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] if runs else None, sha(listed), sha(kept))
    found = {r["doc_id"]: tuple(r)[1:] for r in periodic_runs(spark, folder).collect()}
    assert found.keys() == lines.keys()
    assert all(found[i] == row for i, (n, row) in lines.items() if n < 3000)
    assert sum(row[0] for n, row in lines.values()) > 10


def phrases_of(rows, least, best):
    """Plain: all counts, all scores, all drops."""
    out = []
    for lang in {x or "und" for x, _ in rows}:
        f, n = Counter(), 0
        for x, text in rows:
            if (x or "und") == lang:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
                for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
                    words = re.findall(r"[^\x20\x09]+", piece)
                    n += len(words)
                    f.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
        made = []
        for p, a in f.items():
            if len(p) > 1 and a >= least:
                longer = [f[q] for q in f if len(q) > len(p) and f[q] >= least and p in (q[:2], q[1:])] if len(p) == 2 else []
                if not any(100 * x >= 50 * a for x in longer):
                    cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                    score, k = min(cuts)
                    made.append((lang, " ".join(p), a, f[p[:k]], f[p[k:]], n, score))
        made.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(made[:best])]
    return sorted(out)


@pytest.mark.parametrize(("least", "best"), [(3, 10), (3, 40), (2, 100_000), (5, 3)])
def test_phrases_as_brute_force(spark, least, best):
    draw = random.Random(least * best)
    rows = []
    for i in range(150):
        words = [draw.choice(["Alpha", "beta", "gamma delta", "New York City", "of the", "é x", "a.b", "q\tr", "s\nt", f"w{draw.randint(0, 30)}"]) for _ in range(draw.randint(0, 80))]
        rows.append((draw.choice(["en", "de", None, "und"]), draw.choice([" ", "  "]).join(words)))
    rows += [("en", None), ("fr", ""), ("xx", "one"), ("en", rows[0][1])]
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("rank", F.lit(1)).withColumn("phrase", F.lit("x")).repartition(3)
    made = phrases.collocations(df, least=least, best=best)
    assert made.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, made.collect())) == phrases_of(rows, least, best)


def test_phrases_of_odd_tables(spark):
    df = spark.createDataFrame([(None, "x y " * 200_000), ("en", "a b")], "lang string, text string")
    found = [tuple(r) for r in phrases.collocations(df).collect()]
    assert sorted(found) == phrases_of([(None, "x y " * 200_000), ("en", "a b")], 10, 2000)
    assert phrases.collocations(df.limit(0)).count() == 0


def test_crowded_cells_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "_cell", lambda codes: np.zeros(len(codes), np.int64))
    draw = random.Random(3)
    rows = [("en", " ".join(draw.choice("abcdefgh") for _ in range(200))) for _ in range(20)]
    df = spark.createDataFrame(rows, "lang string, text string")
    table = phrases._table
    monkeypatch.setattr(phrases, "_table", lambda cells: table(cells.withColumn("cell", F.lit(0))))
    assert sorted(map(tuple, phrases.collocations(df, least=4, best=50).collect())) == phrases_of(rows, 4, 50)
