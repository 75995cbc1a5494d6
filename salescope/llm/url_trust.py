"""URL filter: host rules, and trust propagated over the link graph.

Pages that a rule allows are trusted seeds of their hosts, blocked ones
distrusted.  Personalised PageRank carries trust along the host links, and
distrust against them.  A host without a rule is blocked if its distrust, less
its trust, reaches a share of its pages.

Host links are the absolute links of the pages' HTML and the step between a
host and its parent domain.  Mass that would end at a host without links goes
back to the seeds, which only scales the result, so it is applied once, at the
end.  DataFrame operations only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.store import materialise

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host part of absolute links in attributes.
LINK = r"""(?i)\s(?:href|src|action|cite)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""

_BY_RULE, _DISTRUSTED = "__by_rule", "__distrusted"


@dataclass(frozen=True)
class Rule:
    """A verdict for the urls under ``host/path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _plain_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null or a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return _plain_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _by_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst, w)``: links between different hosts, counted."""
    links = pages.where("html is not null").select("host", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), 1))).alias("dst"))
    bare = F.regexp_replace(F.regexp_replace(_plain_lower(F.col("dst")), r"^.*@", ""), r":\d*$", "")
    links = links.select(F.col("host").alias("src"), bare.alias("dst")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))
    hosts = pages.select(F.col("host").alias("src")).distinct()
    upward = hosts.select("src", F.regexp_extract("src", r"^[^.]*\.(.*\..*)$", 1).alias("dst"), F.lit(1).cast("long").alias("w")).where("dst <> ''")
    both = links.unionByName(upward).unionByName(upward.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return both.where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.sum("w").alias("w"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float, rounds: int, every: int = 4) -> DataFrame:
    """``(kind, node, x)``: personalised PageRank of ``seeds`` (kind, node, s);
    kind 0 follows the edges, kind 1 goes against them.  Normalised to the
    seeds' mass."""
    along = edges.select(F.lit(0).alias("kind"), F.col("src").alias("node"), F.col("dst").alias("to"), "w")
    against = edges.select(F.lit(1).alias("kind"), F.col("dst").alias("node"), F.col("src").alias("to"), "w")
    steps = along.unionByName(against)
    leaving = steps.groupBy("kind", "node").agg(F.sum("w").alias("out"))
    steps = materialise(steps.join(leaving, ["kind", "node"]).select("kind", "node", "to", (F.col("w") / F.col("out")).alias("p")), "steps")
    seeds = materialise(seeds.where("s > 0"), "seeds")
    x = seeds.withColumnRenamed("s", "x")
    start = seeds.select("kind", "node", (F.col("s") * (1 - damping)).alias("x"))
    for i in range(rounds):
        sent = steps.join(x, ["kind", "node"]).select("kind", F.col("to").alias("node"), (F.col("x") * F.col("p") * damping).alias("x"))
        x = sent.unionByName(start).groupBy("kind", "node").agg(F.sum("x").alias("x"))
        if (i + 1) % every == 0 or i + 1 == rounds:
            x = materialise(x, "ranks")
    scale = x.groupBy("kind").agg(F.sum("x").alias("got")).join(seeds.groupBy("kind").agg(F.sum("s").alias("put")), "kind")
    # two rows
    return x.join(F.broadcast(scale), "kind").select("kind", "node", (F.col("x") * F.col("put") / F.col("got")).alias("x"))


def judge_urls(pages: DataFrame, rules: list[Rule], damping: float = 0.85, rounds: int = 12, threshold: float = 0.25) -> DataFrame:
    """``pages`` (page_id, url, html) with host, path, rule and verdict of every
    row, without the HTML.

    A rule fits its host and all subdomains if the path starts with the rule's;
    the longest wins and gives the verdict.  Else the host is blocked if
    ``distrust - trust >= threshold * pages`` of its propagated seeds (rounded
    to six places).  A url without a host has no evidence and is allowed.  A
    null html has no links.  The new columns replace columns of their names; all
    other columns stay, whatever their names.  Repeated rows count as pages each; an
    empty table gives no rows.
    """
    host, path = split_url(F.col("url"))
    plain = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    name, verdict = _by_rule(rules, F.col("host"), F.col("path"))
    ruled = plain.withColumns({"rule": name, _BY_RULE: verdict})
    # one scan of the HTML; the graph and its seeds are far smaller
    edges = materialise(host_edges(ruled.select("host", "html")), "edges")
    allowed, blocked = (F.sum(F.when(F.col(_BY_RULE) == v, 1).otherwise(0)) for v in ("allow", "block"))
    hosts = materialise(ruled.where("host <> ''").groupBy("host").agg(F.count(F.lit(1)).alias("n"), allowed.alias("good"), blocked.alias("bad")), "hosts")
    seeds = hosts.select(F.lit(0).alias("kind"), F.col("host").alias("node"), F.col("good").cast("double").alias("s"))
    seeds = seeds.unionByName(hosts.select(F.lit(1).alias("kind"), F.col("host").alias("node"), F.col("bad").cast("double").alias("s")))
    ranks = propagate(edges, seeds, damping, rounds).groupBy("node").agg(F.sum(F.when(F.col("kind") == 1, F.col("x")).otherwise(-F.col("x"))).alias("net"))
    of_host = hosts.join(ranks, hosts["host"] == ranks["node"], "left").select(
        "host", (F.round(F.coalesce("net", F.lit(0.0)) / F.col("n"), 6) >= threshold).alias(_DISTRUSTED)
    )
    found = F.when(F.coalesce(_DISTRUSTED, F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.drop("html").join(of_host, "host", "left").withColumn("verdict", F.coalesce(_BY_RULE, found)).drop(_BY_RULE, _DISTRUSTED)
