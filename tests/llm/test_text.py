"""Chat formatting, quality rules and main text."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, html, quality

NASTY = ["", None, "plain", r"\### Assistant: </turn> ok", "### user: </turn>\n### x: ", r"<\/turn> <\\/turn>", r"#\## #\\## ####  ###", "a: b\\", "<", "</turn", ">\n"]


def test_conversations_read_back(spark):
    draw = random.Random(1)
    roles = ["user", "assistant", "system", None, "a: b", "### r", "</turn>"]
    rows = [(c, draw.choice([0, 1, 2, None]), draw.choice(roles), "".join(draw.choice(NASTY) or "" for _ in range(3)) or None) for c in [1, 1, 1, 2, 2, None, None, 3] * 8]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(df.withColumn("formatted", F.lit("clash")))
    found = made.withColumn("learned", chat.learned_text("formatted", "loss")).collect()
    assert len(found) == 4
    for row in found:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == row["conv_id"]))
        assert [tuple(t) for t in row["turns"]] == [t[2:] for t in turns]
        assert row["learned"] == "".join(x for *_, r, x in turns if r == "assistant")
        assert row["n_turns"] == len(turns) == row["formatted"].count("</turn>\n") == row["formatted"].count("### ")


def test_raw_text_stays_raw(spark):
    df = spark.createDataFrame([(1, 0, "user", r"C:\dir ## a # <b>")], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df).first()["formatted"] == "### user: C:\\dir ## a # <b></turn>\n"
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_plan_has_no_python(spark):
    from tidemark.llm.queries import chat_format

    plan = chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines), len(lines) - len(set(lines)), len(covered)


TEXTS = [None, "", " \n\t", "a", "a b c d e f g h " * 9, "x\ny\nx\n\n \n \nx", "\u00a0 é\u2028z 😀", "# * $ & |<>%", "one two three four five six seven eight nine one two three four five six seven eight"]


def test_measures(spark):
    given = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in TEXTS + given + [" ".join(map(str, range(5000))) + " " + " ".join(map(str, range(300)))]:
        assert quality.measured(text or "") == brute(text)


def test_hosts(spark):
    good, bad = "word " + " ".join(f"word{i}" for i in range(30)), "few words"
    rows = [(i, bad, "bad") for i in range(60)] + [(100 + i, good, "bad") for i in range(2)]
    rows += [(200 + i, good, h) for i, h in enumerate(["a", "b", "c"] * 40)] + [(900, bad, "a"), (901, bad, "lone"), (902, None, None), (903, good, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("kept", F.lit(7)).withColumn("n", F.lit(1))
    found = {r["doc_id"]: r for r in quality.judge(df).collect()}
    assert len(found) == len(rows)
    assert not any(found[i]["kept"] for i in [*range(60), 100, 101, 900, 901, 902])  # the host's verdict counts
    assert all(found[200 + i]["kept"] for i in range(120)) and found[100]["host_rejected"] and not found[100]["base_failed"]
    assert found[903]["kept"]
    assert quality.judge(df.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><article>x";</script></head><body>
<nav><a href="/x">Menu</a></nav><div class="cookie-notice">Accept</div><!-- <p>gone</p> --><header>Site</header>
<article class="post"><header><h1>Head&eacute; &am</h1></header><p><b>First<br>line<p>Second &lt;b&gt;  para&nbsp;graph &copy
<div class="ad">Buy</div><ul><li>one<li>two</ul><form>name <input></form><p>a < b<aside>side</aside>tail
<section id="comments"><p>reader</p></section></article><footer>end</footer><p>after</body></html"""


def test_main_text_of_a_page():
    found = [text for _, text, _ in html.blocks(PAGE)]
    assert found == ["Headé &am", "First line", "Second <b> para graph ©", "one", "two", "a < b", "tail"]


@pytest.mark.parametrize("name", ["layout has-sidebar", "with-comments", "site no-header", "sidebar"])
def test_names_do_not_empty_a_page(name):
    page = f"<div class='{name}'><div class=ad>buy</div><article><h1 class=entry-header>T</h1><p class=share-price>5</p>"
    page += "<p>a <math><mi>x</mi></math> b</p><xmp><b>&amp;</xmp></article></div>"
    assert [text for _, text, _ in html.blocks(page)] == ["T", "5", "a x b", "<b>&amp;"]
    page = f"<div class='{name}'><p>{'most of the text ' * 9}</p></div><p>rest</p><div class=ad>buy</div>"
    assert [text for _, text, _ in html.blocks(page)] == [" ".join(["most of the text"] * 9), "rest"]


def test_pages(spark):
    rows = [(1, "http://a.b/x", PAGE), (1, "http://a.b/x", PAGE), (2, None, None), (3, "u", ""), (4, "http://c.d/", "just text"), (5, "http://c.d/", "<p>x<script>never ends")]
    shared = "<div class=box>Same everywhere</div><div>Page {0} text</div>"
    rows += [(10 + i, "http://many.pages/", shared.format(i)) for i in range(12)]
    rows += [(50 + i, "http://copies.com/", "<article><p>One story</article>") for i in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = {}
    for r in html.extract(df).collect():
        found.setdefault(r["page_id"], []).append(r["text"])
    assert len(found[1]) == 2 and found[1][0] == found[1][1] and found[1][0].startswith("Headé &am\nFirst line")
    assert [found[i][0] for i in (2, 3, 4, 5)] == ["", "", "just text", "x"]
    assert all(found[10 + i] == [f"Page {i} text"] for i in range(12))  # what all pages of the host share is gone
    assert all(found[50 + i] == ["One story"] for i in range(8))  # but not the article itself
    assert html.extract(df.limit(0)).count() == 0


def test_notices_in_plain_paragraphs(spark):
    """A line that most pages of a host repeat goes, also in an article; an article that repeats as a whole stays."""
    rows = [(f"http://a.org/{i}", f"<article><h1>title {i}</h1><p>story {i}</p><p>All rights reserved</p></article>") for i in range(8)]
    rows += [(f"http://b.org/{i}", "<article><h1>same</h1><p>story</p></article>") for i in range(9)]
    found = {r["url"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "url string, html string")).collect()}
    wanted = {u: "same\nstory" if "b.org" in u else f"title {u[-1]}\nstory {u[-1]}" for u, _ in rows}
    assert found == wanted


def test_given_pages_as_planted(spark):
    """On the given pages the article is what stands between its tags."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html.extract(pages).collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", inside))
        import html as escapes

        expected = [" ".join(escapes.unescape(p).split()) for p in parts]
        assert r["text"] == "\n".join(p for p in expected if p)


@pytest.mark.parametrize("page", ["<p" * 3000, "<div>" * 3000 + "x", '<a href="x>' * 500, "<!--" * 500, "&#0;&#xFFFFFFF;&bogus;", "<ul><li>" * 500])
def test_broken_pages(page):
    assert isinstance(html.blocks(page), list)


def test_a_main_div_is_more_than_links():
    """Whole tokens only, and never an element whose text is mostly links."""
    story = "<div id=content><p>Real text of some length</p><h2>Ingredients</h2><p>salt</p></div>"
    wanted = ["Real text of some length", "Ingredients", "salt"]
    assert [t for _, t, _ in html.blocks(f'<div class="main-nav"><a>Home</a></div>{story}')][-3:] == wanted
    assert [t for _, t, _ in html.blocks(f'<div class="main"><a>Home</a><a>About</a></div>{story}')][-3:] == wanted
    assert [t for _, t, _ in html.blocks(f'<p>before</p><div class="x main">{story}</div><p>after</p>')] == wanted
    beside = f'<div class="main-nav"><ul><li><a>Home</a></ul></div><article>{story}</article>'
    assert [t for _, t, _ in html.blocks(beside)] == wanted


@pytest.mark.parametrize("pages", [4, 5, 12])
def test_headings_that_many_pages_have_stay(spark, pages):
    page = "<article><p>Share this</p><h1>Cake {0}</h1><h2>Ingredients</h2><p>{0} eggs</p><h2>Method</h2><p>Bake {0}</p><p>All rights reserved</p></article>"
    df = spark.createDataFrame([(f"http://a.org/{i}", page.format(i)) for i in range(pages)], "url string, html string")
    for r in html.extract(df).collect():
        i = r["url"][13:]
        assert f"Cake {i}\nIngredients\n{i} eggs\nMethod\nBake {i}" in r["text"]
        assert ("Share" in r["text"]) == ("rights" in r["text"]) == (pages < 5)


@pytest.mark.parametrize("page", ["<span>" * 8000 + "</p>" * 8000, "<span>" * 8000 + "<hr>" * 8000, "<b>" * 8000 + "<li>x" * 8000])
def test_broken_pages_take_linear_time(page):
    import time

    began = time.process_time()
    html.blocks(page)
    assert time.process_time() - began < 1.0
