"""Near-duplicates, url filters, mixing, nearest vectors and the pipeline, against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import ann, mixing, neardup, urls
from tidemark.llm.graph import components


def prose(draw, n):
    return [f"w{draw.randint(0, 4000)}" for _ in range(n)]


def weights_of(texts):
    """Plain: each text's shingles with their weights, document frequencies counted by cell."""
    split = [(t or "").encode().split() for t in texts]
    found = [Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter() for w in split]
    name = {}
    for counts in found:
        for words in counts:
            keys, _ = neardup.shingles(b" ".join(words).decode())
            name[words] = int(keys[0])
    cells = Counter(name[s] >> 64 - neardup.CELL_BITS for counts in found for s in counts)
    docs = sum(bool(c) for c in found)
    idf = lambda s: min(max(math.log((docs + 1) / (cells[name[s] >> 64 - neardup.CELL_BITS] + 1)) / math.log1p(docs), 0), 1)
    return [{s: (1 + math.log(n)) * (1 + neardup.DAMP * idf(s)) for s, n in counts.items()} for counts in found]


def similarity(x, y):
    least = sum(min(w, y[s]) for s, w in x.items() if s in y)
    return least / (sum(x.values()) + sum(y.values()) - least) if x and y else 0.0


def near_links(texts):
    heavy = weights_of(texts)
    return [
        (i, j) for i, a in enumerate(texts) for j, b in enumerate(texts[:i])
        if (a or "") == (b or "") or similarity(heavy[i], heavy[j]) >= 0.8
    ]


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(4)
    texts = [" ".join(prose(draw, draw.randint(30, 200))) for _ in range(120)]
    base = prose(draw, 150)
    for i in range(60):  # one group of copies, each changed in its own way
        copy = list(base)
        for _ in range(i % 3):
            copy[draw.randrange(len(copy))] = f"new{draw.randint(0, 10**6)}"
        texts.append(" ".join(copy))
    for text in texts[:15]:
        words = text.split()
        words[len(words) // 2] = "changed"
        texts += [" ".join(words), text.replace(" ", "\n")]
    return texts + texts[:30] + [None, "", "", "lone", "lone", "two words", "   "]


def classes_of(links, n):
    of = list(range(n))

    def top(i):
        while of[i] != i:
            i = of[i]
        return i

    for a, b in links:
        of[max(top(a), top(b))] = min(top(a), top(b))
    return [top(i) for i in range(n)]


def test_near_duplicates(spark, corpus):
    rows = list(enumerate(corpus))
    links = near_links(corpus)
    expected = classes_of(links, len(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7).withColumn("bucket", F.lit(1))
    found = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in neardup.classes(df).collect()}
    sizes = Counter(expected)
    assert found == {i: (c, sizes[c]) for i, c in enumerate(expected)}
    kept = neardup.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected))


def test_no_link_of_a_band_is_lost(spark, monkeypatch):
    """A large cluster, and more small ones than a round has pivots, all in one band and with a passage in common."""
    draw = random.Random(12)
    passage, texts = prose(draw, 30), []
    for copies in [40] + [2] * 40:
        base = prose(draw, 100)
        for _ in range(copies):
            copy = list(base)
            copy[draw.randrange(len(copy))] = f"new{draw.randint(0, 10**6)}"
            texts.append(" ".join(passage + copy))
    rows = list(enumerate(texts))
    expected = classes_of(near_links(texts), len(rows))
    one_band = {f"b{i}": F.lit(i).cast("long") for i in range(neardup.BANDS)}
    signed = neardup._distinct_texts
    monkeypatch.setattr(neardup, "_distinct_texts", lambda *a: signed(*a).withColumns(one_band))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()} == dict(enumerate(expected))


def test_texts_that_differ_are_not_compared(spark, monkeypatch):
    """pipeline and op4: texts of a group that share a band and rare shingles, but too little of the rest, are not left to compare."""
    draw = random.Random(8)
    base = [f"w{draw.randrange(10**9)}" for _ in range(300)]
    texts = []
    for i in range(20):
        spots = draw.sample(range(0, 300, 5), 15)
        for own in (spots[5:10], spots[10:]):
            words = list(base)
            for at in spots[:5]:
                words[at] = f"x{i}x{at}"
            for at in own:
                words[at] = f"y{i}y{at}"
            texts.append(" ".join(words))
    one_band = {f"b{i}": F.lit(i).cast("long") for i in range(neardup.BANDS)}
    signed, verified, compared = neardup._distinct_texts, neardup._verified, []

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(neardup, "_distinct_texts", lambda *a: signed(*a).withColumns(one_band))
    monkeypatch.setattr(neardup, "_verified", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()}
    ones = np.ones(1 << neardup.CELL_BITS, np.float32)
    a, *others = map(neardup.shingles, texts)
    assert max(neardup.similarities(a, others, ones)) < 0.72 and found == {i: i for i in range(40)}
    assert compared == [39, 0]


def test_marks_differ_no_more_than_texts():
    draw = random.Random(9)
    for n in (1, 4, 5, 40, 3000):
        base = [f"w{draw.randrange(500)}" for _ in range(n)]
        other = [f"v{draw.randrange(500)}" if draw.random() < 0.2 else w for w in base]
        a, b = (neardup.shingles(" ".join(w)) for w in (base, other))
        x, y = neardup.marks([a, b])
        cells = sum(int(c).bit_count() for c in (x ^ y).view(np.uint64))
        apart = len(np.setxor1d(a[0], b[0]))
        assert cells <= apart and (cells - apart) % 2 == 0 and (n < 40 or cells > 0)


def test_near_texts_share_a_rare_shingle():
    draw = random.Random(13)
    idf = np.random.default_rng(13).uniform(1, 1.25, 1 << neardup.CELL_BITS).astype(np.float32)
    near = 0
    for i in range(400):
        base = prose(draw, draw.randint(1, 120)) + ["x"] * (i % 40)
        other = list(base)
        for _ in range(draw.randint(0, 3)):
            other[draw.randrange(len(other))] = "other"
        a, b = (neardup.shingles(" ".join(w)) for w in (base, other))
        if neardup.similarities(a, [b], idf)[0] >= 0.8:
            near += 1
            (x, x_tail), (y, y_tail) = (neardup._prefix(t, idf) for t in (a, b))
            both = [min(x_tail[list(x).index(k)], y_tail[list(y).index(k)]) for k in set(x.tolist()) & set(y.tolist())]
            assert max(both) >= 0.8 / 1.8 * (x_tail[0] + y_tail[0]) - 1e-6
    assert near > 50


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, "a b c d e f")] * 4 + [(None, "a b c d e f"), (None, "x"), (2, "x"), (2, "y y y"), (None, "null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in neardup.classes(df).collect())
    assert found == {(1, 1, 5): 4, (None, 1, 5): 1, (None, 2, 2): 1, (2, 2, 2): 1, (2, 2, 1): 1, (None, None, 1): 1}
    assert sorted(r["text"] for r in neardup.deduplicate(df).collect()) == ["a b c d e f", "null id", "x", "y y y"]
    assert neardup.classes(df.limit(0)).count() == 0 and neardup.deduplicate(df.limit(0)).count() == 0


def test_samples_collide_as_weighted_jaccard():
    draw = random.Random(8)
    idf = np.linspace(1, 1.25, 1 << neardup.CELL_BITS).astype(np.float32)
    base = prose(draw, 400)
    for changed in (5, 30, 80):
        other = list(base)
        for i in draw.sample(range(len(base)), changed // 5):
            other[i] = "other"
        a, b = (neardup.shingles(" ".join(w) + " x x x x x x x x") for w in (base, other))
        wanted = neardup.similarities(a, [b], idf)[0]
        keys = np.concatenate([a[0], b[0]])
        heavy = np.log(np.concatenate([neardup.weights(*a, idf), neardup.weights(*b, idf)])).astype(np.float32)
        rates = []
        for salt in range(40):  # other draws, by other names of the shingles
            drawn = neardup.samples(keys ^ np.uint64(salt * 0x1234567), heavy, np.array([0, len(a[0])]))
            rates.append((drawn[0] == drawn[1]).mean())
        assert abs(np.mean(rates) - wanted) < 0.05


def test_near_pairs_share_a_band():
    """Recall at the threshold: of pairs with a similarity of 0.8 to 0.85, all but one in a thousand."""
    draw = random.Random(14)
    idf, met, near = np.ones(1 << neardup.CELL_BITS, np.float32), 0, 0
    while near < 400:
        base = prose(draw, 300)
        other = list(base)
        for i in draw.sample(range(300), 7):
            other[i] = "other"
        texts = [" ".join(base), " ".join(other)]
        a, b = map(neardup.shingles, texts)
        if 0.8 <= neardup.similarities(a, [b], idf)[0] < 0.85:
            near += 1
            x, y = neardup._bands(pa.array(texts), idf).to_pylist()
            met += any(x[f"b{i}"] == y[f"b{i}"] for i in range(neardup.BANDS))
    assert met >= 397


def test_components(spark):
    draw = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(draw.randint(100, 200), draw.randint(100, 200)) for _ in range(60)]
    df = spark.createDataFrame(links, "a long, b long")
    expected = classes_of(links, 201)
    assert {r["node"]: r["component"] for r in components(df).collect()} == {i: expected[i] for link in links for i in link}
    assert components(df.limit(0)).count() == 0


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]


def test_rules(spark):
    cases = {
        "http://a.com/x?q#f": ("a.com", "/x", "com/", "allow"),
        "HTTPS://WWW.Example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "x://b.example.com/en/": ("b.example.com", "/en/", "example.com/en/", "block"),
        "http://com/": ("com", "/", "com/", "allow"),
        "http://xcom/": ("xcom", "/", None, "allow"),
        "http://a.com": ("a.com", "", None, "allow"),
        "http://a.com:80/": ("a.com:80", "/", None, "allow"),
        "http://Ä.net/es/?a://b": ("Ä.net", "/es/", "net/es/", "block"),
        "no scheme": ("", "", None, "allow"),
        "://h#x/y": ("h", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    df = spark.createDataFrame([(u, None, "clash") for u in cases], "url string, html string, host string")
    found = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(df, RULES).collect()}
    spammed = {"http://Ä.net/es/?a://b"}  # its host is a blocked seed, but it has no other page
    assert {u: v for u, v in found.items() if u not in spammed} == {u: v for u, v in cases.items() if u not in spammed}
    assert urls.judge(df.limit(0), RULES).count() == 0


def test_trust_spreads_over_links(spark):
    draw = random.Random(6)
    hosts = [f"h{i}.org" for i in range(12)] + ["good.com", "bad.net"]
    pages = [(f"http://{h}/p", "".join(f'<a class=x href="//{draw.choice(hosts)}/z">' for _ in range(3))) for h in hosts for _ in range(2)]
    pages += [("http://bad.net/es/1", ""), ("http://bad.net/es/2", ""), ("http://bad.net/es/3", ""), ("http://farm.org/", '<A HREF=http://BAD.net/x>' * 3)]
    df = spark.createDataFrame(pages, "url string, html string")
    links = {(r[0], r[1]): r[2] for r in urls.host_links(df, "url", "html").collect()}
    expected = Counter()
    for url, page in pages:
        a = url.split("/")[2]
        for part in page.split("href=")[1:] if "href=" in page else page.split("HREF=")[1:]:
            b = part.strip('"').split("/")[2].lower()
            if a != b:
                expected[a, b] += 1
    assert links == dict(expected)
    verdict = urls.fitting(RULES, urls.host_of(F.col("url")), urls.path_of(F.col("url")))["verdict"]
    known = df.select(urls.host_of(F.col("url")).alias("host"), verdict.alias("verdict"))
    found = {r["host"]: (r["trust"], r["distrust"]) for r in urls.host_trust(known, urls.host_links(df, "url", "html")).collect()}
    names = sorted(found)
    weights = np.zeros((len(names), len(names)))
    for (a, b), n in links.items():
        weights[names.index(a), names.index(b)] = n
    for k, seed, matrix in ((0, "good.com", weights), (1, "bad.net", weights.T)):
        start = np.array([float(n == seed) for n in names])
        rank, out = start, matrix.sum(axis=1, keepdims=True)
        step = np.divide(matrix, out, out=np.zeros_like(matrix), where=out > 0)
        for _ in range(300):
            flow = rank @ step
            rank = urls.DAMPING * flow + (1 - urls.DAMPING * flow.sum()) * start
        assert np.allclose([found[n][k] for n in names], rank, atol=1e-5)
    judged = {r["url"]: r["verdict"] for r in urls.judge(df, RULES).collect()}
    assert judged["http://farm.org/"] == "block" and judged["http://bad.net/p"] == "block" and judged["http://good.com/p"] == "allow"


def water(sizes, weights):
    total, target, free = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while free:
        level = left / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * level > 3 * sizes[i]]
        for i in over or free:
            target[i] = 3.0 * sizes[i] if over else weights[i] * level
        if not over:
            break
        left -= sum(target[i] for i in over)
        free -= set(over)
    return target


def test_mix(spark):
    draw = random.Random(9)
    rows = [(i, draw.choice(["a"] * 9 + ["b", "c", "d", None, "é", "Z"]), " ".join(["w"] * draw.choice([0, 1, 5, 40, 300]))) for i in range(3000)]
    rows += [(5000, "tiny", "one"), (5001, "none", None), (5002, "big", "w " * 20_000)] + [(6000, "a", "same same")] * 5
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("target", F.lit("clash"))
    made = mixing.mix(mixing.with_size(df).drop("text"))
    found = made.collect()
    again = mixing.mix(mixing.with_size(df.repartition(9)).drop("text")).collect()
    key = lambda r: (r["doc_id"], r["size"], r["taken"])
    assert sorted(map(key, found)) == sorted(map(key, again)) and len(found) == len(rows)
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += len((text or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    target = dict(zip(names, water([sizes[n] for n in names], [1 + i % 3 for i in range(len(names))]), strict=True))
    taken, longest = Counter(), Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], target[r["source"]], abs_tol=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for name in names:
        assert abs(taken[name] - target[name]) <= max(0.01 * target[name], longest[name] / 2 + 1)
    assert mixing.mix(mixing.with_size(df.limit(0))).count() == 0


def test_tilts_are_the_optimum(spark):
    """Rates within a source follow exp(tilt * size / scale), cut at most, and meet the target."""
    sizes = spark.createDataFrame([("a", n) for n in range(1, 200)] + [("b", 7), ("b", 500)], "source string, size long")
    targets = mixing.source_targets(sizes, weights=(1, 5))
    tilt = {r["source"]: r for r in mixing.tilts(sizes, targets).collect()}
    for r in targets.collect():
        own = [s["size"] for s in sizes.where(F.col("source") == r["source"]).collect()]
        t = tilt[r["source"]]
        got = sum(n * min(3.0, math.exp(t["tilt"] * n / t["scale"])) for n in own)
        assert math.isclose(got, r["target"], rel_tol=1e-5)


def exact(vectors, query, k):
    away = [(math.dist(v, vectors[query]), i) for i, v in vectors.items() if i != query]
    return sorted(away)[:k]


def test_nearest_vectors(spark):
    draw = np.random.default_rng(3)
    centres = draw.standard_normal((12, 16))
    vectors = {i: (centres[i % 12] + 0.2 * draw.standard_normal(16)).astype(np.float32).tolist() for i in range(3000)}
    for i in range(2000, 2400):
        vectors[i] = vectors[2000]  # one vector very often
    bad = [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [None] * 16), (None, vectors[1]), (9005, []), (9100, [float("inf")] * 16)]
    rows = [*vectors.items(), *bad, (5, vectors[5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    before = ann.CELL
    ann.CELL = 256  # many cells
    try:
        found = ann.nearest(df, F.col("vec_id") % 100 == 0).collect()
    finally:
        ann.CELL = before
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert sorted(got) == list(range(0, 3000, 100))
    hits = 0
    for query, answers in got.items():
        wanted = exact(vectors, query, 10)
        assert [r for r, _ in answers] == sorted(r for r, _ in answers) and len(answers) == 10
        assert all(math.isclose(s, math.dist(vectors[i], vectors[query]), rel_tol=1e-12, abs_tol=1e-12) for s, i in answers)
        hits += len({i for _, i in answers} & {i for _, i in wanted})
    assert hits >= 0.9 * 300
    assert [i for _, i in got[2100]] == [i for i in range(2000, 2011) if i != 2100][:10]


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (100, [3.0, 4.0, 5.0])], "vec_id long, embedding array<double>")
    found = [tuple(r) for r in ann.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 2, 0.0), (0, 2, 1, math.sqrt(2))]
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_chi_square():
    assert math.isclose(ann.chi_square_quantile(0.95, 2), -2 * math.log(0.05), rel_tol=1e-9)
    draws = np.random.default_rng(1).chisquare(8, 200_000)
    assert abs((draws <= ann.chi_square_quantile(0.97, 8)).mean() - 0.97) < 0.002


def test_pipeline(spark):
    """Each stage next to a plain version of it."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    (_, rules), (_, dedup), (_, mix), (_, tokens) = corpus_pipeline.STAGES
    good = rules(spark, docs, folder)
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    one = dedup(spark, good, folder)
    before = {r["doc_id"]: r["text"] for r in good.collect()}
    heavy = dict(zip(before, weights_of(list(before.values())), strict=True))
    ids = [r["doc_id"] for r in one.collect()]
    assert len({before[i] for i in ids}) == len(ids)
    assert all(similarity(heavy[a], heavy[b]) < 0.8 for i, a in enumerate(ids) for b in ids[:i])
    mixed = mix(spark, one, folder)
    assert mixed.columns == docs.columns
    assert set(Counter(r["doc_id"] for r in mixed.collect()).values()) <= {1, 2, 3}
    final = tokens(spark, mixed, folder)
    assert final.count() == mixed.count() and final.where("NOT same").count() == 0
    assert corpus_pipeline.run(spark, folder).count() == final.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, folder)
    assert empty.count() == 0


def test_columns_are_worked_on_in_slices():
    """Slices hold all rows once, in order; a row larger than a slice is one; no rows, no slice."""
    import pyarrow as pa

    from tidemark.llm.common import PART, parts

    texts = ["a" * (PART // 2), "", None, "b" * (3 * PART)] * 3 + ["c"] * 1000
    column = pa.array(texts, pa.string())
    found = list(parts(column))
    assert len(found) > 3 and pa.concat_arrays(found).to_pylist() == texts
    assert not list(parts(pa.array([], pa.string())))
    assert pa.concat_arrays(list(parts(column.slice(5, 20)))).to_pylist() == texts[5:25]
