"""URL filter: rules for hosts and paths, and for the rest what the link graph says, in DataFrame
functions only.

Rules judge single pages. The share of a host's pages that rules allow is its trust, the share they
block its distrust. Both spread over host edges by personalised PageRank, trust along the links,
distrust against them (who links to a blocked host answers for it). A second run with a seed of one
everywhere gives what a host would get if every host were wholly trusted (or blocked); the quotient is
the share among the hosts that reach it, between 0 and 1, and is compared with a threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import Stored, column

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = "(?i)(?:href|src|action)\\s*=\\s*[\"']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\\s>]+)"


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or a text without ``://``."""
    pattern = "^(?s:.*?)://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return lower_ascii(part(1)), part(2)


def judged(pages: DataFrame, rules: tuple[Rule, ...], id_col: str, url_col: str) -> DataFrame:
    """page_id, host, path, rule and action by the longest rule that fits. ``rules`` is a short list: it
    becomes one expression."""
    host, path = url_parts(column(url_col).cast("string"))
    frame = pages.select(column(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    longest = sorted(rules, key=lambda r: -len(r.name))
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(longest):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, action = F.when(fits, r.name).otherwise(rule), F.when(fits, r.action).otherwise(action)
    return frame.withColumns({"rule": rule, "action": action})


def host_edges(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """src, dst, weight: links from a host's pages to other hosts, and a link both ways between a host
    and the domain that it is a part of (down to two labels). Counted before the shuffle."""
    host, _ = url_parts(column(url_col).cast("string"))
    base = pages.select(host.alias("src"), column(html_col).cast("string").alias("html")).where("src <> ''")
    found = base.select("src", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)))).alias("dst"))
    links = found.select("src", lower_ascii(F.regexp_replace("dst", "^[^@]*@", "")).alias("dst")).where("dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    labels = F.split("host", "\\.")
    chain = base.select(F.col("src").alias("host")).distinct().select(labels.alias("l")).where("size(l) > 2").select(
        F.explode(F.expr("transform(sequence(1, size(l) - 2), i -> struct(array_join(slice(l, i, size(l)), '.') as sub, array_join(slice(l, i + 1, size(l)), '.') as top))")).alias("e")
    ).select("e.sub", "e.top").distinct()
    both = chain.select(F.col("sub").alias("src"), F.col("top").alias("dst")).union(chain.select(F.col("top").alias("src"), F.col("sub").alias("dst")))
    return links.union(both.withColumn("weight", F.lit(1.0))).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int = 15, store_each: int = 5) -> DataFrame:
    """host, trust, distrust, each a share in 0..1.

    ``seeds``: host, allowed, blocked (shares of its pages); ``edges``: src, dst, weight. Every
    ``store_each`` rounds the ranks are written to the shared folder and read again."""
    way = lambda name, a, b: edges.select(F.lit(name).alias("way"), F.col(a).alias("src"), F.col(b).alias("dst"), "weight")
    directed = way("trust", "src", "dst").union(way("distrust", "dst", "src"))
    out = directed.groupBy("way", "src").agg(F.sum("weight").alias("total"))
    graph = Stored(directed.join(out, ["way", "src"]).select(F.col("way").alias("along"), "src", "dst", (F.col("weight") / F.col("total")).alias("share")), "urls-graph").frame
    hosts = seeds.select("host").union(edges.select("src")).union(edges.select("dst")).distinct().join(seeds, "host", "left")
    start = hosts.select("host", F.explode(F.array(F.struct(F.lit("trust").alias("way"), F.coalesce("allowed", F.lit(0.0)).alias("seed")), F.struct(F.lit("distrust").alias("way"), F.coalesce("blocked", F.lit(0.0)).alias("seed")))).alias("s")).select("host", "s.way", "s.seed")
    base = Stored(start, "urls-seeds").frame
    ranks = base.select("way", "host", F.col("seed").alias("rank"), F.lit(1.0).alias("most"))
    for i in range(1, rounds + 1):
        sent = ranks.join(graph, (F.col("host") == F.col("src")) & (F.col("way") == F.col("along"))).groupBy("way", F.col("dst").alias("host")).agg(F.sum(F.col("rank") * F.col("share")).alias("got"), F.sum(F.col("most") * F.col("share")).alias("got_most"))
        ranks = base.join(sent, ["way", "host"], "left").select(
            "way", "host", ((1 - damping) * F.col("seed") + damping * F.coalesce("got", F.lit(0.0))).alias("rank"), (F.lit(1 - damping) + damping * F.coalesce("got_most", F.lit(0.0))).alias("most")
        )
        if i % store_each == 0:
            ranks = Stored(ranks, "urls-ranks").frame
    share = lambda name: F.max(F.when(F.col("way") == name, F.col("rank") / F.col("most"))).alias(name)
    return ranks.groupBy("host").agg(share("trust"), share("distrust"))


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5, damping: float = 0.85, rounds: int = 15, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, trust, distrust.

    A page that a rule fits has the rule's verdict. Others are blocked if their host's distrust is at
    least ``threshold`` and greater than its trust. Null urls and urls without ``://`` have an empty host,
    which has no edges and no seed: allowed. Null html has no links; repeated rows give a row each; an
    empty table gives no rows; other columns are not read."""
    page = Stored(judged(pages, rules, id_col, url_col), "urls-pages").frame
    share = lambda action: F.avg(F.when(F.col("action") == action, 1.0).otherwise(0.0))
    seeds = page.where("host <> ''").groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked"))
    edges = Stored(host_edges(pages, url_col, html_col), "urls-edges").frame
    scores = propagate(Stored(seeds, "urls-seed").frame, edges, damping, rounds)
    known = page.join(scores, "host", "left")
    bad = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    return known.select("page_id", "host", "path", "rule", F.coalesce("action", F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")
