"""Main text of web pages, with a style tree per host.

Pages are read into blocks: text between the edges of block elements, with the path of open block elements (tags and
their classes) as its *style node*. Blocks inside elements that are never article text by tag (menus, forms, scripts ...)
or by a token of class, id or role (advert, comment, cookie ...) are left out, and on a page with an article or main
element everything outside of it. A name alone doesn't silence an element that holds an article, a main element or more than
half of the page's text.

The remaining blocks of all pages of a host are merged into one style tree. A node's importance is made of the entropy
of its presentation (how the number of its blocks varies over pages) and of its content: a content that stands on as many
pages as the node has full entropy and tells nothing, one that stands on a single page tells all. Nodes that enough pages
share and whose importance is low are removed from each page. Plain paragraphs and headings directly in an article share
their nodes with all of the article, so there content alone decides: a block is removed if it stands on most of a host's
different page bodies. Pages that repeat as a whole are one body, and stay.

White space within a block becomes one blank; blocks are joined by line feeds in page order. Character references are
decoded as HTML has it. Null pages are empty; null urls belong to the host "". Broken markup is read on as browsers do
roughly: unclosed elements end with their parents, an unfinished tag or comment ends the page. Repeated rows are pages of
their own. New columns take the place of columns of the same name.
"""

from __future__ import annotations

import re
from collections import Counter
from html import escape, unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from tidemark.llm.common import kept_table, text_of
from tidemark.llm.urls import host_of

BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section
    select summary table tbody td tfoot th thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg object canvas audio video".split())
NOISE_TAGS = frozenset("nav footer aside form head header menu button select dialog search fieldset".split())
#: Whole tokens of class, id or role.
NOISE_NAMES = frozenset(
    """ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary consent contentinfo
    cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter
    notice notices pager pagination popup promo promotion promoted related reply replies respond search share sharing sidebar
    signup skip social sponsor sponsored subscribe toolbar widget""".split()
)
#: A div with one of these tokens is an article, unless its text is mostly links.
MAIN_NAMES = frozenset(["main", "main-content", "maincontent"])
KEPT_TAGS = frozenset("html body article main".split())
#: A start of the key ends open elements of the values, up to the nearest of the barriers.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"<]*"|'[^'<]*'|[^>"'])*+>|[^>]*(?:>|\Z))""", re.S
)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
PAGES, LOW, GAMMA = 5, 0.2, 0.9

Block = tuple[int, str, bool]


def _names(attributes: str) -> tuple[str, set[str]]:
    """The classes as they stand, and all tokens of class, id and role."""
    shown, words = "", set()
    for name, value in NAMED.findall(attributes):
        value = value.strip("\"'").lower()
        words.update(value.split())
        if name.lower() == "class":
            shown = " ".join(value.split())
    return shown, words


def blocks(page: str) -> list[Block]:
    """Style node, text, and whether it is plain article text, for each block that may be main text."""
    # style node, pieces of text with the named elements they stand in, plain, within article
    found: list[tuple[int, list[tuple[str, tuple[int, ...], bool]], bool, tuple[int, ...]]] = []
    text: list[tuple[str, tuple[int, ...], bool]] = []
    # an open element: tag, style node, within noise, articles it stands in (0: by tag, else a div of that name), plain since
    # the article, elements with noise names, within a link
    stack: list[tuple[str, int, bool, tuple[int, ...], bool, tuple[int, ...], bool]] = [("", 0, False, (), False, (), False)]
    named, holders, mains, opened = 0, set(), 0, Counter()
    at = 0

    def flush() -> None:
        if text:
            _, node, noise, inside, plain, _, _ = stack[-1]
            if not noise:
                found.append((node, text.copy(), plain, inside))
            text.clear()

    def close(depth: int) -> None:
        if any(tag in BLOCKS for tag, *_ in stack[depth:]):
            flush()
        opened.subtract(tag for tag, *_ in stack[depth:])
        del stack[depth:]

    for token in TOKEN.finditer(page):
        if token.start() < at:
            continue
        if token.start() > at and not stack[-1][2]:
            text.append((page[at : token.start()], *stack[-1][5:]))
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name = name.lower()
        if token[1]:
            for depth in range(len(stack) - 1, 0, -1) if opened[name] else ():
                if stack[depth][0] == name:
                    close(depth)
                    break
                if name not in BLOCKS and stack[depth][0] in BLOCKS:
                    break
            continue
        if name in RAW:
            if not token[3].endswith("/>"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                at = end.start() if end else len(page)
            continue
        if name == "xmp" and not stack[-1][2]:  # its markup is text
            end = re.compile(r"</xmp(?=[\s/>])", re.I).search(page, at)
            start, at = at, end.start() if end else len(page)
            text.append((f" {escape(page[start:at])} ", *stack[-1][5:]))
            continue
        if name == "br":
            text.append((" ", *stack[-1][5:]))
        if name in BLOCKS:
            flush()
            closing, barrier = CLOSES.get(name, (set(), set()))
            ends = opened["p"] or any(opened[tag] for tag in closing)
            for depth in range(len(stack) - 1, 0, -1) if ends else ():
                tag = stack[depth][0]
                if tag == "p" or tag in closing:
                    close(depth)
                    if not opened["p"] and not any(opened[tag] for tag in closing):
                        break
                elif tag in barrier or (tag in BLOCKS and not closing):
                    break
        if name in VOID:
            continue
        _, node, noise, inside, plain, roots, linked = stack[-1]
        shown, words = _names(token[3]) if "=" in token[3] else ("", set())
        silent = False
        if name not in KEPT_TAGS:
            noise = noise or (name in NOISE_TAGS and not (name == "header" and inside))
            silent = bool(words & NOISE_NAMES)
        elif name == "article" and words & {"comment", "comments", "comment-body", "reply"}:
            noise = True
        if (noise or silent) and not stack[-1][2]:
            if name not in BLOCKS and text:  # noise inside a block: what stands before it is kept
                text.append((" ", roots, linked))
        if silent and not noise:
            named += 1
            roots = (*roots, named)
        if name in ("article", "main") and not noise:
            holders.update(roots)
        if name in ("article", "main"):
            inside, plain = (*inside, 0), True
        elif name == "div" and words & MAIN_NAMES:
            mains += 1
            inside, plain = (*inside, mains), True
        elif name in BLOCKS:
            plain = plain and not words
        if name in BLOCKS:
            node = xxhash.xxh3_64_intdigest(f"{node} {name} {shown}") >> 1
        stack.append((name, node, noise, inside, plain, roots, linked or name == "a"))
        opened[name] += 1
    if at < len(page) and not stack[-1][2]:
        text.append((page[at:], *stack[-1][5:]))
    flush()
    if named:
        sizes, whole = dict.fromkeys(range(1, named + 1), 0), 0
        for _, pieces, _, _ in found:
            for piece, roots, _ in pieces:
                size = sum(map(len, piece.split()))
                whole += size
                for root in roots:
                    sizes[root] += size
        silenced = {root for root, size in sizes.items() if root not in holders and 2 * size <= whole}
        found = [(n, [p for p in pieces if silenced.isdisjoint(p[1])], *rest) for n, pieces, *rest in found]
    kept, sizes = [], Counter()
    for node, pieces, plain, inside in found:
        words = " ".join(unescape("".join(piece for piece, *_ in pieces)).split())
        if words:
            kept.append(((node, words, plain), inside))
            for piece, _, linked in pieces if any(inside) else ():
                size = sum(map(len, piece.split()))
                for number in inside:
                    sizes[number] += -size if linked else size
    # a div is no article for its name alone if its text is mostly links
    kept = [(block, any(number == 0 or sizes[number] > 0 for number in inside)) for block, inside in kept]
    articles = any(inside for _, inside in kept)
    return [block for block, inside in kept if inside or not articles]


def _column(function, kind: str):
    def run(batches):
        for batch in batches:
            yield function(*batch) if isinstance(batch, tuple) else function(batch)

    return F.arrow_udf(run, kind, ArrowUDFType.SCALAR_ITER)


def style_nodes(pages: DataFrame, host: str, html: str) -> DataFrame:
    """One row per host and style node: pages that have it, presentation, content and importance (0 to 1)."""

    def run(batch: pa.Array) -> pa.Array:
        said = []
        for page in batch.to_pylist():
            counts: dict[tuple[int, int], int] = {}
            nodes: dict[int, int] = {}
            for node, words, _ in blocks(page or ""):
                content = xxhash.xxh3_64_intdigest(words) >> 1
                counts[node, content] = counts.get((node, content), 0) + 1
                nodes[node] = nodes.get(node, 0) + 1
            said.append(
                [{"node": n, "content": c, "n": k, "is_style": False} for (n, c), k in counts.items()]
                + [{"node": n, "content": k, "n": 1, "is_style": True} for n, k in nodes.items()]
            )
        return pa.array(said, pa.list_(pa.struct([("node", pa.int64()), ("content", pa.int64()), ("n", pa.int64()), ("is_style", pa.bool_())])))

    read = _column(run, "array<struct<node:long,content:long,n:long,is_style:boolean>>")
    rows = pages.select(F.col(host).alias("host"), F.explode(read(F.col(html))).alias("b")).select("host", "b.*")
    merged = rows.groupBy("host", "node", "is_style", "content").agg(F.count("*").alias("pages"), F.sum("n").alias("n"))
    logs = F.col("pages") * F.log("pages")
    told = merged.groupBy("host", "node").agg(
        F.sum(F.when(F.col("is_style"), F.col("pages"))).alias("pages"),
        F.sum(F.when(F.col("is_style"), logs)).alias("styles"),
        F.sum(F.when(~F.col("is_style"), F.col("n"))).alias("n"),
        F.sum(F.when(~F.col("is_style"), F.col("n") * F.log("pages"))).alias("spread"),
    )
    whole = F.log("pages")
    several = F.col("pages") > 1
    presentation = F.when(several, 1 - F.col("styles") / F.col("pages") / whole).otherwise(1.0)
    content = F.when(several, 1 - F.col("spread") / F.col("n") / whole).otherwise(1.0)
    told = told.withColumns({"presentation": presentation, "content": content})
    return told.withColumn("importance", (1 - GAMMA) * F.col("presentation") + GAMMA * F.col("content"))


def recurring(pages: DataFrame, host: str, html: str, least: int = PAGES) -> DataFrame:
    """Host and content of blocks that stand on most of a host's page bodies, and on at least so many.

    Pages with the same blocks are one body, so a page that repeats as a whole makes nothing recur.
    """

    def run(batch: pa.Array) -> pa.Array:
        said = []
        for page in batch.to_pylist():
            contents = [xxhash.xxh3_64_intdigest(words) >> 1 for _, words, _ in blocks(page or "")]
            body = xxhash.xxh3_64_intdigest(" ".join(map(str, contents))) >> 1
            said.append({"body": body, "contents": list(dict.fromkeys(contents))})
        return pa.array(said, pa.struct([("body", pa.int64()), ("contents", pa.list_(pa.int64()))]))

    read = _column(run, "struct<body:long,contents:array<long>>")
    bodies = pages.select(F.col(host).alias("host"), read(F.col(html)).alias("b")).select("host", "b.*")
    bodies = kept_table(bodies.filter(F.size("contents") > 0).dropDuplicates(["host", "body"]), "bodies")
    whole = bodies.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("bodies"))
    told = bodies.select("host", F.explode("contents").alias("content")).groupBy("host", "content").agg(F.count("*").alias("n"))
    told = told.filter(F.col("n") >= least).join(whole, F.col("host") == F.col("of"))
    return told.filter("2 * n > bodies").select("host", "content")


def extract(
    df: DataFrame, url: str = "url", html: str = "html", text: str = "text", pages: int = PAGES, low: float = LOW
) -> DataFrame:
    """Adds the main text. Nodes that at least so many pages share and whose importance is below low are removed.

    So are blocks whose content stands on at least so many and on most of a host's different page bodies, also in articles,
    but only before the first and after the last block of the page's own: headings and cells that many pages have stay. A
    page without blocks of its own keeps all.

    The markup is read three times, for the trees, the contents and the texts, and never shuffled unless a host's removed nodes are too
    many to be broadcast by Spark's own size check.
    """
    hosts = df.select(host_of(df[url]).alias("host"), df[html].alias("html"))
    nodes = style_nodes(hosts, "host", "html").filter((F.col("pages") >= pages) & (F.col("importance") < low))
    empty = F.lit(None).cast("long")
    both = nodes.select("host", "node", empty.alias("content")).union(
        recurring(hosts, "host", "html", pages).select("host", empty.alias("node"), "content")
    )
    removed = both.groupBy(F.col("host").alias("__host")).agg(
        F.struct(F.collect_list("node").alias("nodes"), F.collect_list("content").alias("contents")).alias("__removed")
    )
    removed = kept_table(removed, "removed")

    def run(page: pa.Array, gone: pa.Array) -> pa.Array:
        texts = []
        for said, nodes in zip(page.to_pylist(), gone.to_pylist(), strict=True):
            out, often = (set(nodes["nodes"]), set(nodes["contents"])) if nodes else ((), ())
            kept = [words for node, words, plain in blocks(said or "") if plain or node not in out]
            own = [i for i, words in enumerate(kept) if xxhash.xxh3_64_intdigest(words) >> 1 not in often] if often else ()
            texts.append("\n".join(kept[own[0] : own[-1] + 1] if own else kept))
        return pa.array(texts, pa.string())

    joined = df.join(removed, host_of(df[url]) == F.col("__host"), "left")
    return joined.withColumn(text, _column(run, "string")(text_of(df[html]), F.col("__removed"))).drop("__host", "__removed")
