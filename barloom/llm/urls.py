"""URL filter: listed rules, and for what they leave open trust and distrust along host links."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*([^"'\s>]+)"""
DAMPING = 0.85
# Rounds that the SQL check spells out; the flow itself runs until it is still.
ROUNDS = 20
THRESHOLD = 0.5
# Smallest change of a score that counts as one.
STILL = 1e-12


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for ``host``, its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def judge(pages: DataFrame, rules: list[Rule], threshold: float = THRESHOLD,
          damping: float = DAMPING, rounds: int | None = None, id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), one row per row of ``pages``.

    The longest rule that fits a url decides. What no rule fits is decided per host: seeds are the
    shares of a host's pages that rules allow (trust) and block (distrust). Trust flows along the
    links between hosts, split by number of links, distrust against them; both decay by ``damping``
    per step, until nothing changes (by more than STILL), or for ``rounds`` steps where given. Steps
    shrink the change of all scores together by ``damping``, which lies below 1. A host whose distrust exceeds its
    trust by ``threshold`` or more is blocked.

    Pages fold to hosts and links to weighted host edges before any join, links within a host
    count nothing. A null url, or one without ``://``, has the empty host and path, which no rule fits
    and no link reaches. Null html has no links. Repeated rows count as pages of their own; other
    columns are ignored; an empty table gives an empty result.
    """
    seen = pages.select(F.col(id_col).alias("page_id"),
                        host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    ruled = seen.withColumn("fit", _longest(rules, F.col("host"), F.col("path")))
    share = {kind: F.avg(F.when(F.col("fit.verdict") == verdict, 1.0).otherwise(0.0)).alias(kind)
             for kind, verdict in (("trust", "allow"), ("distrust", "block"))}
    seeds = stage(ruled.groupBy("host").agg(*share.values()), "seeds")
    flows = stage(_flows(pages, url_col, html_col), "flows")
    scores = stage(_propagated(seeds, flows, damping, rounds), "scores")
    excess = F.round(F.col("distrust") - F.col("trust"), 9)
    method = F.when((F.col("host") != "") & (excess >= threshold), "block").otherwise("allow")
    return (ruled.join(scores, "host").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), method).alias("verdict"),
        F.round("trust", 9).alias("trust"), F.round("distrust", 9).alias("distrust")))


def _longest(rules: list[Rule], host: Column, path: Column) -> Column:
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The last wrapped is tried first.
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        here = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        fits = F.when(here, F.struct(F.lit(rule.host + rule.path).alias("rule"),
                                     F.lit(rule.verdict).alias("verdict"))).otherwise(fits)
    return fits


def _flows(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(kind, src, dst, share): trust from linking to linked host, distrust back."""
    links = F.transform(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), 1),
                        lambda link: F.when(link.startswith("//"), F.concat(F.lit("x:"), link))
                        .otherwise(link))
    absolute = F.filter(links, lambda link: link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"))
    edges = (pages.select(host_of(F.col(url_col)).alias("src"), F.explode(absolute).alias("link"))
             .select("src", host_of(F.col("link")).alias("dst"))
             .filter("src <> dst AND src <> '' AND dst <> ''")
             .groupBy("src", "dst").agg(F.count("*").alias("links")))
    both = stage(edges, "edges")
    both = both.select(F.lit("trust").alias("kind"), "src", "dst", "links").union(
        both.select(F.lit("distrust"), "dst", "src", "links"))
    totals = both.groupBy("kind", "src").agg(F.sum("links").alias("total"))
    return both.join(totals, ["kind", "src"]).select(
        "kind", "src", "dst", (F.col("links") / F.col("total")).alias("share"))


def _propagated(seeds: DataFrame, flows: DataFrame, damping: float,
                rounds: int | None) -> DataFrame:
    """(host, trust, distrust) after the flow; hosts that are only linked to start from 0."""
    start = seeds.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust)")
                         .alias("kind", "seed"))
    start = start.union(flows.select(F.col("dst").alias("host"), "kind", F.lit(0.0)))
    start = stage(start.groupBy("host", "kind").agg(F.sum("seed").alias("seed")), "start")
    scores = start.withColumn("score", F.col("seed"))
    if not flows.isEmpty():
        for _ in count() if rounds is None else range(rounds):
            got = (flows.join(scores.select("kind", F.col("host").alias("src"), "score"),
                              ["kind", "src"])
                   .groupBy("kind", F.col("dst").alias("host"))
                   .agg(F.sum(F.col("share") * F.col("score")).alias("got")))
            after = stage(scores.withColumnRenamed("score", "before")
                          .join(got, ["kind", "host"], "left")
                          .select("host", "kind", "seed", "before",
                                  (F.col("seed") + damping * F.coalesce("got", F.lit(0.0)))
                                  .alias("score")), "round")
            scores = after.drop("before")
            if after.filter(F.abs(F.col("score") - F.col("before")) > STILL).isEmpty():
                break
    return scores.groupBy("host").agg(
        *(F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)).alias(kind)
          for kind in ("trust", "distrust")))
