"""URL filter: rules first, trust carried over host edges for the rest.

Hosts are nodes. Edges lead from a page's host to the hosts its absolute links name, and
between a host and the domain one label shorter (down to two labels), weighted by the
number of pages. Hosts whose pages the rules allow are trusted seeds, hosts whose pages
they block are blocked seeds, each with the share of its pages. Trust is a personalised
PageRank from the trusted seeds along the edges; distrust one from the blocked seeds
against them, so that who links to blocked hosts is distrusted. Seeds weigh the same
in a table of any size. A host is blocked if distrust makes up more than ``SHARE`` of its
trust and distrust. Both shrink alike where mass is divided over many neighbours, so the
share has no scale: it does not matter how many others link to a blocked host.

What is still on its way after k steps is at most ``DAMPING`` ** k of the seeds' mass, so
``STEPS`` follows from ``TOLERANCE``, for any graph. Trust and distrust are moved together,
a join and a sum a step, partly done before the shuffle; every ``CUT`` steps the ranks are
written to the shared folder. A host with at least a 2000th of all edges is a hub; its
edges are dealt out under numbers, and its rank goes to each of them.

A null url, or one without ``://``, has an empty host and path; no rule fits it, and as
it has no edges it is allowed. Of rules of equal length the first by name counts. A null html has no links. Repeated rows are judged alike
and add weight. Without rules or pages nothing is blocked. Other columns do not
interfere.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.functions.sizing import staged
from ballast.llm.shared import HOT_SHARE, whole

DAMPING = 0.85
TOLERANCE = 1e-3
STEPS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
CUT = 6
SHARE = 0.5
DIGITS = 9  # of the share, so that sums in another order give the same verdict
HUB_EDGES = 1000  # of a hub, under one number
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href\s*=\s*["']?([a-z][a-z0-9+.-]*://[^"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed by the contract.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(whole(url), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(whole(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as a struct of rule and verdict, or null."""
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in sorted(rules, key=lambda r: (-len(r.name), r.name))
    ]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*fits, none)


def edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst, weight: the number of pages behind the edge, at least one."""
    own = pages.select(host(F.col(url)).alias("src"), F.col(html).alias("html"))
    links = own.select(
        "src",
        F.explode(
            F.array_distinct(
                F.transform(F.regexp_extract_all(whole(F.col("html")), F.lit(LINK), F.lit(1)), host)
            )
        ).alias("dst"),
    )
    labels = F.split("src", r"\.")
    # A host is led to the domain one label shorter, and that on, to two labels.
    chain = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    family = (
        own.select("src")
        .filter("src <> ''")
        .distinct()
        .select(chain.alias("chain"))
        .select(F.explode(F.arrays_zip("chain", F.expr("slice(chain, 2, size(chain))").alias("up"))).alias("x"))
        .select(F.col("x.chain").alias("src"), F.col("x.up").alias("dst"))
        .filter("dst is not null")
        .distinct()
    )
    back = family.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return (
        links.unionByName(family)
        .unionByName(back)
        .filter("src <> '' and dst <> '' and src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )


def spread(seeds: DataFrame, edges: DataFrame, steps: int = STEPS) -> DataFrame:
    """Personalised PageRank, once for each ``side``: side, host, rank; ``seeds`` has
    side, host and seed, each pair once; ``edges`` side, src, dst and weight. What reaches
    a host without edges goes no further."""
    out = staged(
        edges.groupBy("side", "src").agg(F.sum("weight").alias("out"), F.count("*").alias("n")), "out"
    )
    total = out.agg(F.sum("n")).first()[0] or 0
    # At most HOT_SHARE of them.
    hubs = out.filter(F.col("n") >= max(HUB_EDGES, total / HOT_SHARE)).select(
        "side", "src", F.ceil(F.col("n") / HUB_EDGES).cast("int").alias("numbers")
    )
    any_hub = not hubs.isEmpty()
    shares = staged(
        edges.join(out, ["side", "src"])
        .join(F.broadcast(hubs), ["side", "src"], "left")
        .select(
            "side",
            "src",
            F.coalesce(F.pmod(F.xxhash64("dst"), F.col("numbers")), F.lit(0)).cast("int").alias("number"),
            "dst",
            (F.col("weight") / F.col("out")).alias("share"),
        ),
        "shares",
    )
    start = seeds.select("side", "host", ((1 - DAMPING) * F.col("seed")).alias("rank"))
    rank = start
    for step in range(1, steps + 1):
        dealt = rank.withColumnRenamed("host", "src")
        if any_hub:
            number = F.explode(F.sequence(F.lit(0), F.coalesce("numbers", F.lit(1)) - 1))
            dealt = dealt.join(F.broadcast(hubs), ["side", "src"], "left").select(
                "side", "src", "rank", number.alias("number")
            )
        else:
            dealt = dealt.withColumn("number", F.lit(0))
        moved = dealt.join(shares, ["side", "src", "number"]).select(
            "side", F.col("dst").alias("host"), (DAMPING * F.col("rank") * F.col("share")).alias("rank")
        )
        rank = start.unionByName(moved).groupBy("side", "host").agg(F.sum("rank").alias("rank"))
        if step % CUT == 0 or step == steps:
            rank = staged(rank, "rank")
    return rank


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust."""
    parts = pages.select(
        F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path")
    ).withColumn("_fit", longest_rule(F.col("host"), F.col("path"), rules))
    shares = staged(
        parts.filter("host <> ''")
        .groupBy("host")
        .agg(
            F.avg(F.when(F.col("_fit.verdict") == "allow", 1.0).otherwise(0.0)).alias("good"),
            F.avg(F.when(F.col("_fit.verdict") == "block", 1.0).otherwise(0.0)).alias("bad"),
        ),
        "seeds",
    )
    along = staged(edges(pages, url, html), "edges")
    both = along.withColumn("side", F.lit("trust")).unionByName(
        along.select(
            F.col("dst").alias("src"), F.col("src").alias("dst"), "weight", F.lit("distrust").alias("side")
        )
    )
    seeds = shares.select("host", F.expr("stack(2, 'trust', good, 'distrust', bad) as (side, seed)"))
    ranks = spread(seeds.filter("seed > 0"), both)
    judged = staged(
        shares.select("host")
        .join(ranks.groupBy("host").pivot("side", ["trust", "distrust"]).agg(F.sum("rank")), "host", "left")
        .na.fill(0.0, ["trust", "distrust"]),
        "judged",
    )
    share = F.round(F.col("distrust") / (F.col("trust") + F.col("distrust")), DIGITS)
    # Both sides are stored or scanned, so Spark can split a host with very many pages.
    by_host = F.when((F.col("distrust") > 0) & (share > SHARE), "block").otherwise("allow")
    return parts.join(judged, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("_fit.rule").alias("rule"),
        F.coalesce(F.col("_fit.verdict"), by_host).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
