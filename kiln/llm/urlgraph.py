"""URL filters by link-graph propagation, with DataFrame and SQL functions only.

Rules name hosts, with all their subdomains, and path prefixes; the longest
rule that fits a url judges it.  Other urls are judged by their host, from
personalised PageRanks over host edges: trust starts at hosts by the share of
their urls that a rule allows and flows along links; distrust starts by the
share that a rule blocks and flows against links, to those who link to them; a
reference starts at all hosts alike and flows along links.  A host is blocked
where its distrust exceeds its trust and ``THRESHOLD`` times its reference, that
is, where more distrust gathers than at a host of its place by chance.

Host edges come from absolute links of the pages (links inside a host say
nothing about it) and, with ``site_weight``, from a host to its parent domain
and back, level by level up to the root of all names: pages of a site stand for
each other, and domains without pages pass ranks on.  Edges are aggregated by
pair of hosts before anything is joined, with partial sums, so a host with a
third of all pages costs one row per task and neighbour.  Ranks are carried on
until they change by less than ``TOLERANCE`` in all; the change shrinks by the
damping with each step, so this ends.

Defined results: a null url, or one without ``://``, has an empty host and path
and, like a host that neither rank reaches, is allowed; null html has no links;
repeated rows are judged alike; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: (host, path, verdict); a short list: it becomes part of the plan.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DAMPING = 0.85
THRESHOLD = 1.0
#: Summed change of the three ranks over ``STEPS`` iterations at which they count as settled.
TOLERANCE, STEPS = 2e-3, 6
ROWS_PER_TASK = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)<a\b[^<>]*?\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s<>]+)"""


def _rest(url: Column) -> Column:
    """What follows the first ://, or null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(length, rule, verdict) of the longest rule that fits, or null."""
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h) + len(p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for h, p, v in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,rule:string,verdict:string>")


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, weight): number of pages of a host that link to another host."""
    links = F.regexp_extract_all(F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")), F.lit(_LINK), 1)
    # a link without a scheme starts with //, so a scheme is put before it
    hosts = F.array_distinct(F.transform(links, lambda x: host_of(F.when(x.startswith("//"), F.concat(F.lit("http:"), x)).otherwise(x))))
    each = pages.select(host_of(F.col(f"`{url_col}`").cast("string")).alias("src"), F.explode(hosts).alias("dst"))
    each = each.where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    return each.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def site_edges(hosts: DataFrame, weight: float) -> DataFrame:
    """(src, dst, weight) between each host of ``hosts`` and its parent domain, that and its own, and so on up to the root (an empty name), both ways."""
    labels = F.split("host", r"\.")
    name = lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    levels = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(name(i).alias("src"), name(i + 1).alias("dst")))
    up = hosts.select(F.explode(levels).alias("e")).select("e.*").where("src != dst").distinct()
    return up.union(up.select("dst", "src")).withColumn("weight", F.lit(float(weight)))


RANKS = ("trust", "distrust", "reference")


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust, reference) from edges (src, dst, weight) and seeds (host, allowed, blocked).

    Trust and reference follow edges by their share of what leaves a host;
    distrust goes against them by their share of what enters one.  Mass of hosts
    without a way out is not carried on; only comparisons of the ranks, each
    scaled to one, count.
    """
    total = seeds.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b"), F.count(F.lit(1)).cast("double").alias("n"))
    zero = F.lit(0.0)
    # total has one row
    start = seeds.join(F.broadcast(total), F.lit(True), "left").select(
        "host",
        F.when(F.col("a") > 0, F.col("allowed") / F.col("a")).otherwise(zero).alias("trust"),
        F.when(F.col("b") > 0, F.col("blocked") / F.col("b")).otherwise(zero).alias("distrust"),
        (F.lit(1.0) / F.col("n")).alias("reference"),
    )
    start = cut(start)
    leaves = edges.groupBy("src").agg(F.sum("weight").alias("leaves"))
    enters = edges.groupBy("dst").agg(F.sum("weight").alias("enters"))
    w = edges.join(leaves, "src").join(enters, "dst")
    ways = w.select(F.col("src").alias("host"), F.col("dst").alias("to"), (F.col("weight") / F.col("leaves")).alias("wt"), zero.alias("wd")).union(
        w.select(F.col("dst").alias("host"), F.col("src").alias("to"), zero.alias("wt"), (F.col("weight") / F.col("enters")).alias("wd"))
    )
    ways = cut(ways.groupBy("host", "to").agg(F.sum("wt").alias("wt"), F.sum("wd").alias("wd")))
    # a host graph is small beside the pages: each iteration runs in as many tasks as its edges need
    tasks = ways.count() // ROWS_PER_TASK + 1
    ways = ways.coalesce(tasks)
    way = {"trust": "wt", "distrust": "wd", "reference": "wt"}
    rest = start.select("host", *[(F.col(r) * (1 - damping)).alias(r) for r in RANKS]).coalesce(tasks)
    rank = start.coalesce(tasks)
    while True:
        before = rank
        for _ in range(STEPS):
            moved = rank.join(ways, "host").select(F.col("to").alias("host"), *[(F.col(r) * F.col(way[r]) * damping).alias(r) for r in RANKS])
            rank = moved.union(rest).groupBy("host").agg(*[F.sum(r).alias(r) for r in RANKS]).coalesce(tasks)
        rank = cut(rank)
        both = rank.unionByName(before.select("host", *[(-F.col(r)).alias(r) for r in RANKS]))
        changes = both.groupBy("host").agg(*[F.abs(F.sum(r)).alias(r) for r in RANKS]).agg(*[F.sum(r).alias(r) for r in RANKS]).first()
        if sum(x or 0.0 for x in changes) < tolerance:
            break
    sums = rank.agg(*[F.sum(r).alias(f"sum_{r}") for r in RANKS])
    scaled = rank.join(F.broadcast(sums), F.lit(True), "left")  # sums has one row
    return scaled.select("host", *[F.when(F.col(f"sum_{r}") > 0, F.col(r) / F.col(f"sum_{r}")).otherwise(zero).alias(r) for r in RANKS])


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", site_weight: float = 1.0) -> DataFrame:
    """id, host, path, rule, verdict, trust, distrust, reference of every row."""
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = cut(rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)))
    verdict = F.col("fit.verdict")
    seeds = rows.where("host != ''").groupBy("host").agg(
        F.avg(F.when(verdict == "allow", 1.0).otherwise(0.0)).alias("allowed"),
        F.avg(F.when(verdict == "block", 1.0).otherwise(0.0)).alias("blocked"),
    )
    seeds = cut(seeds)
    edges = host_edges(pages, url_col, html_col)
    if site_weight:
        edges = edges.union(site_edges(seeds.select("host"), site_weight)).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    ranks = propagate(cut(edges), seeds)
    out = rows.join(ranks.where("host != ''"), "host", "left")
    rank = {r: F.coalesce(F.col(r), F.lit(0.0)) for r in RANKS}
    bad = (rank["distrust"] > rank["trust"]) & (rank["distrust"] > THRESHOLD * rank["reference"])
    return out.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(verdict, F.when(bad, "block").otherwise("allow")).alias("verdict"),
        *RANKS,
    )


def op9_url_graph(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
