"""URL filters: rules by host and path, and trust that spreads over links between hosts.

A url that fits rules takes the longest one's verdict. All others take their host's. Hosts of which more than half the
pages are allowed by rules are trusted seeds, those with more than half blocked are blocked seeds, by their pages. Trust
is a personalised PageRank from the trusted seeds along links; distrust is one from the blocked seeds against the links'
direction, because who links to a bad host is suspect and who is linked from it is not. Rank that has no link to follow
returns to the seeds. A host is blocked if its distrust exceeds its trust by margin / number of hosts, about what a host
of no note has by chance; a host that neither reaches is allowed.

Everything is DataFrame functions. Links are absolute http(s) or scheme-less hrefs in the pages' markup; links within a
host don't count. Null urls and urls without "://" have neither host nor path, fit no rule and are allowed. Null markup
has no links. Repeated rows count as often as they stand there.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, kept_table, text_of

#: Ranks are exact to this part of what blocks a host.
DAMPING, MARGIN, NEAR = 0.85, 0.15, 1e-3
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""

Rule = tuple[str, str, str]


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(text_of(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(text_of(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule (verdict, host, path) that fits, as struct of rule and verdict, or null."""
    found = F.lit(None)
    for verdict, domain, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(start))
        found = F.when(fits, F.struct(F.lit(domain + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """source, target and links between different hosts."""
    targets = F.regexp_extract_all(text_of(pages[html]), F.lit(LINK), F.lit(1))
    found = pages.select(host_of(pages[url]).alias("source"), F.explode(targets).alias("target"))
    found = found.withColumn("target", _lower(F.col("target"))).filter("source <> '' AND source <> target")
    return found.groupBy("source", "target").agg(F.count("*").alias("links"))


def host_trust(pages: DataFrame, links: DataFrame) -> DataFrame:
    """From pages (host, verdict or null) and links: host, trust, distrust."""
    counts = pages.filter("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"),
        F.sum((F.col("verdict") == "allow").cast("long")).alias("allowed"),
        F.sum((F.col("verdict") == "block").cast("long")).alias("blocked"),
    )
    links = kept_table(links, "links")
    named = links.select(F.col("source").alias("host")).union(links.select("target")).distinct()
    counts = kept_table(counts.join(named, "host", "full"), "hosts")
    majority = lambda c: F.when(2 * F.coalesce(c, F.lit(0)) > F.col("n"), F.col("n")).otherwise(0)
    seeds = counts.select("host", majority(F.col("allowed")).alias("trust"), majority(F.col("blocked")).alias("distrust"))
    total = seeds.agg(F.sum("trust"), F.sum("distrust")).first()
    share = [F.col(name) / F.lit(float(total[i] or 1)) for i, name in enumerate(("trust", "distrust"))]
    kinds = F.explode(
        F.array(*(F.struct(F.lit(k).alias("kind"), s.alias("seed")) for k, s in zip(("trust", "distrust"), share, strict=True)))
    )
    seeds = kept_table(seeds.select("host", kinds.alias("k")).select("host", "k.kind", "k.seed"), "seeds")
    rank = seeds.withColumn("rank", F.col("seed"))
    if links.head(1):
        rank = _spread(links, rank, seeds, NEAR * MARGIN / max(1, counts.count()))
    return rank.groupBy("host").agg(
        *(F.sum(F.when(F.col("kind") == k, F.col("rank")).otherwise(0.0)).alias(k) for k in ("trust", "distrust"))
    )


def _spread(links: DataFrame, rank: DataFrame, seeds: DataFrame, near: float) -> DataFrame:
    """Rounds until the ranks change by less than near in sum; a round leaves DAMPING of the change, which bounds their number."""

    def steps(kind: str, a: str, b: str) -> DataFrame:
        out = links.groupBy(F.col(a).alias("of")).agg(F.sum("links").alias("all"))
        share = links.join(out, links[a] == out["of"])
        return share.select(F.lit(kind).alias("kind"), F.col(a).alias("host"), F.col(b).alias("to"), (F.col("links") / F.col("all")).alias("share"))

    walk = kept_table(steps("trust", "source", "target").union(steps("distrust", "target", "source")), "walk")
    rank = kept_table(rank, "rank")
    while True:
        flow = rank.select("kind", "host", "rank").join(walk, ["kind", "host"]).groupBy("kind", F.col("to").alias("host"))
        flow = kept_table(flow.agg(F.sum(F.col("rank") * F.col("share")).alias("flow")), "flow")
        sums = {r["kind"]: r["all"] for r in flow.groupBy("kind").agg(F.sum("flow").alias("all")).collect()}  # two rows
        left = F.when(F.col("kind") == "trust", 1 - DAMPING * sums.get("trust", 0.0)).otherwise(
            1 - DAMPING * sums.get("distrust", 0.0)
        )
        moved = rank.join(flow, ["kind", "host"], "left").select(
            "host", "kind", "seed", F.col("rank").alias("was"),
            (DAMPING * F.coalesce("flow", F.lit(0.0)) + left * F.col("seed")).alias("rank"),
        )
        moved = kept_table(moved, "rank")
        forget(rank, flow)
        rank = moved
        if (moved.agg(F.sum(F.abs(F.col("rank") - F.col("was")))).first()[0] or 0.0) < near:
            return rank


def judge(df: DataFrame, rules: list[Rule], url: str = "url", html: str = "html", margin: float = MARGIN) -> DataFrame:
    """Adds host, path, rule (null if none fits) and verdict ("allow" or "block")."""
    host, path = host_of(df[url]), path_of(df[url])
    by_rule = fitting(rules, host, path)
    pages = df.select(host.alias("host"), by_rule["verdict"].alias("verdict"))
    trust = host_trust(pages, host_links(df, url, html))
    trust = kept_table(trust, "trust")
    n = trust.count()
    blocked = trust.filter(F.col("distrust") - F.col("trust") >= margin / max(n, 1))
    blocked = kept_table(blocked.select(F.col("host").alias("__host")), "blocked")
    said = df.withColumns({"host": host, "path": path, "__rule": by_rule})
    said = said.join(blocked, said["host"] == blocked["__host"], "left")
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("__host").isNotNull(), "block").otherwise("allow"))
    return said.withColumns({"rule": F.col("__rule.rule"), "verdict": verdict}).drop("__host", "__rule")
