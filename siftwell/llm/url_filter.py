"""URL filters: rules on hosts and paths, and link-graph propagation for pages that no rule fits. DataFrame functions alone.

Hosts are the nodes. Edges, with the number of links as weight: absolute links in pages, and each host with its parent domain, both
ways. Trust flows along edges from hosts in proportion to their pages under allowing rules (personalised PageRank); distrust flows
against edges from hosts in proportion to their pages under blocking rules. A host is blocked where distrust is at least
``THRESHOLD`` of both together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: (verdict, host and path): a rule fits its host and all subdomains, if the path starts with the rule's; the longest wins.
RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)
DAMPING = 0.85
#: Propagation ends when the mass still to be moved, of 1 each for trust and distrust, is at most this; 0.85 of it is left by a round,
#: so that takes under 45 rounds on any graph.
TOLERANCE = 1e-3
#: Rounds between two cuts of the lineage, each with a look at what is left. Few, as the driver keeps each plan that ran.
CUT_EVERY = 3
#: Links that a task takes in a round: a graph of fewer is one partition, and its rounds need no shuffle.
LINKS_PER_TASK = 250_000
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The rule that decides, as a struct (verdict, rule); null where none fits. Rules are a parameter, a few hundred at most."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """source, target, weight: links summed per pair of hosts before any host is joined, and links to and from parent domains.
    pages: host, html and weight."""
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"(?i)(?:href|src)\s*=\s*[\"']?(?:https?:)?//([^/?#\"'\s<>]+)"), 1)
    linked = pages.select(F.col("host").alias("source"), F.explode(F.transform(links, lambda x: F.translate(x, UPPER, LOWER))).alias("target"))
    # Cut, as it is used twice and has read all pages.
    linked = cut(linked.filter("source <> '' and source <> target").groupBy("source", "target").agg(F.count("*").cast("double").alias("weight")))
    hosts = pages.select("host").union(linked.select("target")).filter("host <> ''").distinct()
    # Every host with the next shorter domain, down to two labels.
    labels = F.split("host", r"\.")
    upward = (
        hosts.withColumn("l", labels)
        .filter(F.size("l") > 2)
        .select(F.explode(F.transform(F.sequence(F.lit(1), F.size("l") - 2), lambda i: F.struct(F.array_join(F.slice("l", i, F.size("l")), ".").alias("source"), F.array_join(F.slice("l", i + 1, F.size("l")), ".").alias("target")))).alias("e"))
        .select("e.source", "e.target")
        .distinct()
    )
    structure = upward.union(upward.select(F.col("target").alias("source"), F.col("source").alias("target"))).withColumn("weight", F.lit(1.0))
    return linked.union(structure).groupBy("source", "target").agg(F.sum("weight").alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """host, trust, distrust. seeds: host, allowed, blocked (numbers of pages); edges: source, target, weight."""
    totals = seeds.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    start = seeds.select(
        "host", (F.col("allowed") / F.lit(float(totals.a or 1))).alias("trust"), (F.col("blocked") / F.lit(float(totals.b or 1))).alias("distrust")
    ).filter("trust > 0 or distrust > 0")
    start = cut(start)
    out_weight = edges.groupBy("source").agg(F.sum("weight").alias("all_out"))
    in_weight = edges.groupBy("target").agg(F.sum("weight").alias("all_in"))
    shares = edges.join(out_weight, "source").join(in_weight, "target")
    # One flow table for both directions: along an edge only trust moves, against it only distrust.
    forward = shares.select(F.col("source").alias("at"), F.col("target").alias("to"), (F.col("weight") / F.col("all_out")).alias("t"), F.lit(0.0).alias("d"))
    backward = shares.select(F.col("target").alias("at"), F.col("source").alias("to"), F.lit(0.0).alias("t"), (F.col("weight") / F.col("all_in")).alias("d"))
    flow = cut(forward.union(backward).groupBy("at", "to").agg(F.sum("t").alias("t"), F.sum("d").alias("d")))
    parts = -(-flow.count() // LINKS_PER_TASK) or 1
    flow = flow.coalesce(parts)
    # trust and distrust are the mass that moved in the last round, t_rest and d_rest all that came to rest, (1 - damping) of each wave.
    rest = lambda c: (F.col(c) * (1 - damping)).alias(f"{c[0]}_rest")
    state = start.coalesce(parts).select("host", "trust", "distrust", rest("trust"), rest("distrust"))
    while True:
        for _ in range(CUT_EVERY):
            moved = flow.join(state.select(F.col("host").alias("at"), "trust", "distrust").filter("trust > 0 or distrust > 0"), "at")
            moved = moved.select(F.col("to").alias("host"), (F.col("trust") * F.col("t") * damping).alias("trust"), (F.col("distrust") * F.col("d") * damping).alias("distrust"))
            moved = moved.select("host", "trust", "distrust", rest("trust"), rest("distrust"))
            still = state.select("host", F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"), "t_rest", "d_rest")
            state = still.unionByName(moved).coalesce(parts).groupBy("host").agg(*[F.sum(c).alias(c) for c in ("trust", "distrust", "t_rest", "d_rest")])
        state = cut(state.coalesce(parts))
        left = state.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
        if max(left.t or 0.0, left.d or 0.0) <= tolerance:
            return state.select("host", F.col("t_rest").alias("trust"), F.col("d_rest").alias("distrust"))


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust (0 where nothing reaches it).

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end; both empty for
    a null url or one without ``://``. Pages without a host, and hosts that neither trust nor distrust reaches, are allowed. A
    null html has no links. Repeated rows are judged alike, and each counts as a page; ids may be null. Extra columns are ignored, an
    empty table gives no rows.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    named = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    ruled = named.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    seeds = ruled.filter("host <> ''").groupBy("host").agg(
        F.sum(F.when(F.col("hit.verdict") == "allow", 1).otherwise(0)).cast("double").alias("allowed"),
        F.sum(F.when(F.col("hit.verdict") == "block", 1).otherwise(0)).cast("double").alias("blocked"),
    )
    rank = propagate(seeds, cut(host_edges(named)))
    share = F.round(F.col("distrust") / (F.col("trust") + F.col("distrust")), 9)
    blocked = F.coalesce(share >= threshold, F.lit(False))
    met = ruled.drop("html").join(rank, "host", "left")
    verdict = F.coalesce(F.col("hit.verdict"), F.when(blocked, "block").otherwise("allow"))
    return met.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), verdict.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("host_trust"), F.coalesce("distrust", F.lit(0.0)).alias("host_distrust"))
