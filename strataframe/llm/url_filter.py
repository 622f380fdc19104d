"""URL filters: rules by host and path, and link-graph propagation for the pages that no rule covers.

Trust flows forward over host links from hosts that allow rules cover (personalised PageRank); distrust flows
backward, from hosts that block rules cover to hosts that link to them. Everything is DataFrame work: pages shrink
to one row a host pair before any join, and each iteration is a table in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import ascii_lower, drop, materialize

HEAVY = 256


@dataclass(frozen=True)
class Rule:
    """One rule: its verdict for a host with all its subdomains, for paths that start with path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """What stands between the first :// and the next /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(rules: list[Rule], host: Column, path: Column) -> Column:
    """struct(rule, verdict) of the longest rule that fits; of equally long ones, that with the longer host."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, weight): pages of host src that link to host dst, another host.

    Links are href values of <a> with a scheme or starting with //; relative links stay on their host and give none.
    Pages whose url or html is null or without host give none.
    """
    href = F.regexp_extract_all(F.col(html_col), F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""), F.lit(1))
    link = F.transform(href, lambda u: url_host(F.when(u.startswith("//"), F.concat(F.lit("http:"), u)).otherwise(u)))
    return (
        pages.select(url_host(F.col(url_col)).alias("src"), F.explode(F.array_distinct(link)).alias("dst"))
        .where("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("weight"))
    )


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, max_iter: int | None = None, tolerance: float = 1e-6) -> DataFrame:
    """(host, trust, distrust) by power iteration, until the total change is under tolerance and no new host is reached.

    damping is under 1, so changes shrink by that much a round and the iteration ends; max_iter can end it before.

    seeds: (host, trust, distrust), the teleport weights; each column is scaled to sum to 1 (all zero: stays zero).
    A host without links out drops what would leave it. Hosts that neither flow reaches have no row.
    """
    both = edges.select(F.lit(True).alias("forward"), "src", "dst", "weight").unionByName(
        edges.select(F.lit(False).alias("forward"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    out = both.groupBy("forward", "src").agg(F.sum("weight").alias("out"))
    flow = materialize(both.join(out, ["forward", "src"]).select("forward", "src", "dst", (F.col("weight") / F.col("out")).alias("p")), "flow")
    long = seeds.select(F.explode(F.array(F.struct(F.lit(True).alias("forward"), "host", F.col("trust").alias("s")), F.struct(F.lit(False).alias("forward"), "host", F.col("distrust").alias("s")))).alias("x")).select("x.*").where("s > 0")
    total = long.groupBy("forward").agg(F.sum("s").alias("total"))  # two rows at most
    start = materialize(long.join(F.broadcast(total), "forward").select("forward", "host", (F.col("s") / F.col("total")).alias("s")), "seeds")
    rank, last = start.select("forward", "host", F.col("s").alias("r")), None
    if links := flow.count():
        # hosts with much of all links, under HEAVY a direction as their links add up to all: their ranks go to every task
        degrees = flow.groupBy("forward", "src").agg(F.count("*").alias("n")).where(F.col("n") * HEAVY > links).select("forward", "src")
        heavy = materialize(degrees, "flow-heavy")
        known = F.broadcast(heavy)
        of_heavy = materialize(flow.join(known, ["forward", "src"]), "flow")
        others = materialize(flow.join(known, ["forward", "src"], "left_anti"), "flow")
        for _ in count() if max_iter is None else range(max_iter):
            ranks = rank.select("forward", F.col("host").alias("src"), "r")
            sent = others.join(ranks, ["forward", "src"]).unionByName(of_heavy.join(F.broadcast(ranks.join(known, ["forward", "src"])), ["forward", "src"]))
            came = sent.select("forward", F.col("dst").alias("host"), (damping * F.col("r") * F.col("p")).alias("r"))
            parts = came.withColumn("old", F.lit(0.0)).unionByName(start.select("forward", "host", ((1 - damping) * F.col("s")).alias("r"), F.lit(0.0).alias("old"))).unionByName(rank.select("forward", "host", F.lit(0.0).alias("r"), F.col("r").alias("old")))
            rank = materialize(parts.groupBy("forward", "host").agg(F.sum("r").alias("r"), F.sum("old").alias("old")), "rank")
            if last is not None:
                drop(last)
            last = rank
            moved, reached = rank.agg(F.sum(F.abs(F.col("r") - F.col("old"))), F.count_if(F.expr("old = 0 AND r > 0"))).first()
            if moved is None or (moved < tolerance and not reached):
                break
    of = lambda forward: F.sum(F.when(F.col("forward") == forward, F.col("r")).otherwise(0.0))
    return rank.groupBy("host").agg(of(True).alias("trust"), of(False).alias("distrust"))


def url_filter(
    pages: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: float = 0.5,
    cover: float = 0.5,
    damping: float = 0.85,
    max_iter: int | None = None,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), one row a page.

    A host is a trusted (blocked) seed if allow (block) rules cover at least the share cover of its pages; its weight
    is the number of those pages. A page without rule gets its host's verdict: block where distrust makes more than
    the share threshold of trust plus distrust, else allow (so also where neither flow arrives, and without host).
    Null urls and those without :// have empty host and path, fit no rule and are allowed. Repeated rows and
    repeated ids give as many rows; an empty table gives none; further columns are not read. rules is a short list
    that becomes one expression. trust and distrust are 0 where no flow arrives.
    """
    urls = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    judged = urls.withColumn("m", matched(rules, F.col("host"), F.col("path")))
    share = lambda verdict: F.sum((F.col("m.verdict") == verdict).cast("long")) / F.count("*")
    seeds = (
        judged.where("host <> ''")
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.coalesce(share("allow"), F.lit(0.0)).alias("a"), F.coalesce(share("block"), F.lit(0.0)).alias("b"))
        .select("host", F.when(F.col("a") >= cover, F.col("a") * F.col("n")).otherwise(0.0).alias("trust"), F.when(F.col("b") >= cover, F.col("b") * F.col("n")).otherwise(0.0).alias("distrust"))
    )
    scores = propagate(host_edges(pages, url_col, html_col), seeds, damping, max_iter)
    scores = scores.select(F.col("host").alias("of_host"), "trust", "distrust")
    bad = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    return judged.join(scores, F.col("host") == F.col("of_host"), "left").select(
        "page_id",
        "host",
        "path",
        F.col("m.rule").alias("rule"),
        F.coalesce(F.col("m.verdict"), F.when(bad, F.lit("block")), F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
