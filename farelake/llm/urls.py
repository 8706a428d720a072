"""URL filtering: rules first, and where none fits, trust that spreads over the links between hosts.

Rules name a host and a path. A rule fits a URL if its host is the URL's or a parent domain of it and the URL's path
starts with the rule's; the longest rule that fits decides.

Other URLs go by their host. Hosts with allowed pages are seeds of trust and hosts with blocked pages are seeds of
distrust, both in proportion to the number of such pages, and both are measured in pages when they are compared. Personalised PageRank carries trust along the edges between
hosts and distrust against them (who links to a bad host is suspect). Edges are absolute links in the
pages' href and src attributes, weighted by the number of pages with such a link, and, with the weight of one
page, the steps between a host and its parent domain, by which a site vouches for its subdomains. Steps end at the
registrable domain (two labels, or three under a suffix such as co.uk), since above it hosts have nothing in common;
addresses in digits have no parents. A host is blocked if its share of distrust exceeds `threshold` of its trust and
distrust together; a host that neither reaches is allowed. So is one without evidence: if neither it nor a parent
has a judged page or a link, all that reaches it comes from other subdomains of its site.

Host edges are aggregated before anything else, so the iteration moves rows per host and edge, not per page.
Each iteration is written to the shared folder.

Edge cases: a null URL or one without :// has an empty host and path, fits no rule and is allowed. A null html has no
links. Repeated rows are judged each and count each. With no seeds of a kind, that kind is zero everywhere. An empty
table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import LOWER, UPPER, prepare, stored

#: (host, path, verdict)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DAMPING = 0.85
#: What is left to spread after so many steps is below a thousandth: DAMPING ** 43.
STEPS = 43
THRESHOLD = 0.5
PARENT_WEIGHT = 1.0
#: Endings of two labels under which domains are registered, and addresses, which have no parents.
SUFFIX = r"(^|\.)(co|com|net|org|gov|edu|ac)\.[a-z]{2}(:\d+)?$"
ADDRESS = r"^\[|(^|\.)\d+(:\d+)?$"


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def by_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for at, prefix, says in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(at + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def with_parents(host: Column) -> Column:
    """The host and its parents down to the registrable domain: a.b.c.d has b.c.d and c.d."""
    labels = F.split(host, r"\.")
    least = F.when(host.rlike(SUFFIX), 3).otherwise(2)
    last = F.when(host.rlike(ADDRESS), 1).otherwise(F.greatest(F.size(labels) - least + 1, F.lit(1)))
    return F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def link_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between different hosts, the weight being the pages of src with a link to dst."""
    links = pages.select(url_host(F.col("url")).alias("src"), F.explode(F.array_distinct(F.regexp_extract_all(
        F.coalesce("html", F.lit("")), F.lit(r"""(?i)(?:href|src)\s*=\s*["']?\s*([a-z][a-z0-9+.-]*://[^"'\s>]+)"""), F.lit(1)))).alias("link"))
    return links.select("src", url_host(F.col("link")).alias("dst")).where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(
        F.count(F.lit(1)).cast("double").alias("weight"))


def host_edges(pages: DataFrame, hosts: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """(src, dst, weight) between different hosts. hosts: (host) of all pages."""
    links = link_edges(pages) if links is None else links
    known = hosts.select("host").unionByName(links.select(F.col("dst").alias("host"))).where("host <> ''").distinct()
    chain = with_parents(F.col("host"))
    steps = known.select(F.explode(F.filter(F.transform(
        chain, lambda c, i: F.struct(c.alias("src"), F.get(chain, i + 1).alias("dst"))), lambda s: s["dst"].isNotNull())).alias("s"))
    steps = steps.select("s.src", "s.dst").distinct().withColumn("weight", F.lit(PARENT_WEIGHT))
    up = steps.unionByName(steps.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    return links.unionByName(up).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagated(edges: DataFrame, seeds: DataFrame, steps: int = STEPS, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) after personalised PageRank from `seeds` (host, trust, distrust).

    Seeds are scaled to a sum of 1 each. Trust that reaches a host without outgoing edges ends there, and
    likewise distrust at one without incoming edges.
    """
    totals = seeds.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
    seeds = stored(seeds.select(
        "host", (F.col("trust") / F.lit(float(totals["t"] or 1))).alias("trust"),
        (F.col("distrust") / F.lit(float(totals["d"] or 1))).alias("distrust")), "seeds")
    out = edges.groupBy("src").agg(F.sum("weight").alias("w_out"))
    into = edges.groupBy("dst").agg(F.sum("weight").alias("w_in"))
    # One row for each edge and direction: `at` hands on to `to`.
    shares = edges.join(out, "src").join(into, "dst")
    shares = stored(
        shares.select(F.col("src").alias("at"), F.col("dst").alias("to"), (F.col("weight") / F.col("w_out")).alias("t"), F.lit(0.0).alias("d"))
        .unionByName(shares.select(F.col("dst").alias("at"), F.col("src").alias("to"), F.lit(0.0).alias("t"), (F.col("weight") / F.col("w_in")).alias("d")))
        .groupBy("at", "to").agg(F.sum("t").alias("t"), F.sum("d").alias("d")), "shares")
    now = seeds
    base = seeds.select("host", ((1 - damping) * F.col("trust")).alias("trust"), ((1 - damping) * F.col("distrust")).alias("distrust"))
    for step in range(steps):
        sent = now.join(shares, now["host"] == shares["at"]).select(
            F.col("to").alias("host"), (damping * F.col("trust") * F.col("t")).alias("trust"), (damping * F.col("distrust") * F.col("d")).alias("distrust"))
        now = base.unionByName(sent).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if step % 4 == 3 or step == steps - 1:
            now = stored(now, "ranks")
    return now


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every row of `pages` (page_id, url, html)."""
    prepare(pages.sparkSession)
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    placed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = by_rule(F.col("host"), F.col("path"), rules)
    placed = stored(placed.withColumns({"rule": rule, "says": says}), "placed")
    hosts = stored(placed.groupBy("host").agg(
        F.count_if(F.col("says") == "allow").cast("double").alias("trust"),
        F.count_if(F.col("says") == "block").cast("double").alias("distrust")), "hosts")
    seeds = hosts.where("host <> '' and trust + distrust > 0")
    links = stored(link_edges(pages), "links")
    ranks = propagated(stored(host_edges(pages, hosts, links), "edges"), seeds)
    totals = seeds.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
    evident = seeds.select("host").unionByName(links.select(F.explode(F.array("src", "dst")).alias("host"))).distinct()
    evident = hosts.where("host <> ''").select("host", F.explode(with_parents(F.col("host"))).alias("at")).join(
        evident.withColumnRenamed("host", "at"), "at", "left_semi").select("host").distinct()
    distrust = F.col("distrust") * F.lit(float(totals["d"] or 0))  # in pages, as they are counted
    bad = distrust > threshold * (F.col("trust") * F.lit(float(totals["t"] or 0)) + distrust)
    suspects = ranks.join(evident.withColumn("evident", F.lit(True)), "host", "left").select(
        "host", "trust", "distrust", (F.coalesce("evident", F.lit(False)) & bad).alias("bad"))
    judged = placed.join(suspects, "host", "left")
    bad = F.coalesce("bad", F.lit(False))
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("says", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
