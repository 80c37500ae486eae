"""URL filters (1): listed rules first, trust and distrust over the host graph for the rest.

A rule names a host, with all its subdomains, and the beginning of a path; the longest rule that fits a url decides. Hosts
most of whose pages are allowed by a rule are trusted seeds, those most of whose pages are blocked are blocked seeds. Trust
flows along links (personalised PageRank: whom trusted hosts link to is likely good), distrust against them (who links to
blocked hosts is likely bad). A page that no rule decides is blocked if its host's distrust is above its trust and above
a floor, else allowed.

The graph has one edge per pair of hosts, weighted by the links of its pages; links within a host are left out. A turn of the
ranking joins the edges with the last ranks and adds up per host; ranks are written to the shared scratch folder between
turns, and only their totals reach the driver.

Defined cases: null urls and urls without ``://`` have an empty host and path, no rule, and are allowed; null html has no
links; hosts that are linked to but have no page pass rank on like any other; without seeds of a kind all ranks of that kind
are 0; repeated rows are judged once each and weigh twice in the graph; extra columns pass through. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.common import apart, ascii_lower, fresh, kept

ALLOW, BLOCK = "allow", "block"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""
Rules = Sequence[tuple[str, str]]  # (verdict, host/path)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def rule_of(host: Column, path: Column, rules: Rules) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does. ``rules`` is a list of bounded length."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame, host: Column, html: Column) -> DataFrame:
    """(src, dst, n): links between different hosts, counted."""
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LINK), F.lit(1))
    full = F.transform(links, lambda x: F.when(x.startswith("//"), F.concat(F.lit("http:"), x)).otherwise(x))
    return (
        pages.select(host.alias("src"), F.explode(full).alias("link"))
        .select("src", host_of(F.col("link")).alias("dst"))
        .filter("src <> '' and dst <> '' and src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )


def personalised_rank(
    edges: DataFrame, seeds: DataFrame, damping: float = 0.85, turns: int = 30, least_change: float = 1e-6
) -> DataFrame:
    """(host, rank) of all hosts of the edges and seeds: PageRank that restarts at the seeds, by their ``weight``.

    Ranks sum to 1 (0 without seeds). What hosts without links hold goes back to the seeds.
    """
    out = edges.groupBy("src").agg(F.sum("n").alias("out"))
    shares = kept(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("out")).alias("share")), "graph-shares")
    total = seeds.agg(F.sum("weight")).first()[0] or 0.0
    hosts = (
        edges.select(F.col("src").alias("host"), F.lit(0.0).alias("seed"))
        .unionByName(edges.select(F.col("dst").alias("host"), F.lit(0.0).alias("seed")))
        .unionByName(seeds.select("host", (F.col("weight") / (total or 1.0)).alias("seed")))
        .groupBy("host")
        .agg(F.sum("seed").alias("seed"))
    )
    hosts = kept(hosts, "graph-hosts")
    ranks = hosts.withColumn("rank", F.col("seed"))
    if not total:
        return ranks.select("host", "rank")
    for _ in range(turns):
        passed = (
            shares.join(ranks.select(F.col("host").alias("src"), "rank"), "src")
            .groupBy("dst")
            .agg(F.sum(F.col("share") * F.col("rank")).alias("got"))
        )
        passed = kept(passed, "graph-passed")
        arrived = passed.agg(F.sum("got")).first()[0] or 0.0
        restart = 1 - damping * arrived
        rank = F.col("seed") * restart + F.coalesce("got", F.lit(0.0)) * damping
        after = (
            ranks.join(passed, ranks.host == passed.dst, "left")
            .select("host", "seed", F.col("rank").alias("before"), rank.alias("rank"))
        )
        ranks = kept(after, "graph-ranks")
        change = ranks.agg(F.sum(F.abs(F.col("rank") - F.col("before")))).first()[0] or 0.0
        if change < least_change:
            break
    return ranks.select("host", "rank")


def filter_urls(
    pages: DataFrame,
    rules: Rules,
    seed_share: float = 0.5,
    damping: float = 0.85,
    turns: int = 30,
    ratio: float = 1.0,
    floor: float = 0.1,
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """``pages`` with a struct ``url_filter``: host, path, rule, verdict, trust and distrust of the host.

    A host is a seed if more than ``seed_share`` of its pages have the same verdict by rule, weighted by those pages.
    Distrust blocks above ``ratio`` times the trust and above ``floor`` times the mean rank of a host.
    """
    pages = apart(pages, "url_filter", keep=(url_column, html_column))
    own, way, fits, match, trusted, distrusted = fresh(pages, "_own", "_path", "_rule", "_host", "_trust", "_distrust")
    url, html = F.col(url_column).cast("string"), F.col(html_column).cast("string")
    host, path = host_of(url), path_of(url)
    edges = kept(host_edges(pages, host, html), "graph-edges")
    judged = pages.select(host.alias("host"), rule_of(host, path, rules)["verdict"].alias("verdict")).filter("host <> ''")
    count = lambda verdict: F.sum(F.when(F.col("verdict") == verdict, 1).otherwise(0)).cast("double")
    seen = kept(
        judged.groupBy("host").agg(count(ALLOW).alias(ALLOW), count(BLOCK).alias(BLOCK), F.count("*").alias("n")), "graph-seeds"
    )
    seeds = lambda verdict: seen.filter(F.col(verdict) > F.col("n") * seed_share).select("host", F.col(verdict).alias("weight"))
    trust = personalised_rank(edges, seeds(ALLOW), damping, turns)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = personalised_rank(back, seeds(BLOCK), damping, turns)
    ranks = (
        seen.select("host")
        .join(trust.withColumnRenamed("rank", "trust"), "host", "left")
        .join(distrust.withColumnRenamed("rank", "distrust"), "host", "left")
        .select(F.col("host").alias(match), *[F.coalesce(c, F.lit(0.0)).alias(name) for c, name in (("trust", trusted), ("distrust", distrusted))])
    )
    ranks = kept(ranks, "graph-verdicts")
    least = floor / max(1, ranks.count())
    bad = (F.col(distrusted) > F.col(trusted) * ratio) & (F.col(distrusted) > least)
    rule = F.col(fits)
    verdict = F.when(rule.isNotNull(), rule["verdict"]).when(bad, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    result = F.struct(
        F.col(own).alias("host"),
        F.col(way).alias("path"),
        rule["rule"].alias("rule"),
        verdict.alias("verdict"),
        F.coalesce(trusted, F.lit(0.0)).alias("trust"),
        F.coalesce(distrusted, F.lit(0.0)).alias("distrust"),
    )
    marked = pages.withColumns({own: host, way: path}).withColumn(fits, rule_of(F.col(own), F.col(way), rules))
    joined = marked.join(ranks, F.col(own) == F.col(match), "left")
    return joined.withColumn("url_filter", result).drop(own, way, fits, match, trusted, distrusted)
