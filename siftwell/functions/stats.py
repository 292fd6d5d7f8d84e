"""Over-representation statistics as Column expressions and windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from .numbers import exact_round

_EXACT = 20
_LOGS = [math.lgamma(k + 1) for k in range(_EXACT)]


def log_factorial(n: str) -> str:
    """SQL of ln n!: a table below 20, from there Stirling's series (error under 1e-12). No table grows with the universe."""
    x = f"cast({n} as double)"
    series = f"({x} + 0.5D) * ln({x}) - {x} + {0.5 * math.log(2 * math.pi)!r}D + 1 / (12 * {x}) - 1 / (360 * {x} * {x} * {x}) + 1 / (1260 * power({x}, 5))"
    table = ", ".join(f"{v!r}D" for v in _LOGS)
    return f"(CASE WHEN {n} < {_EXACT} THEN element_at(array({table}), cast({n} as int) + 1) ELSE {series} END)"


def log_factorials(*ns: str) -> str:
    """SQL of the sum of ln n! of several numbers: one lambda over an array, so that the expression stays small."""
    return f"aggregate(array({', '.join(f'cast({n} as bigint)' for n in ns)}), 0D, (total, v) -> total + {log_factorial('v')})"


def log_choose(n: str, k: str) -> str:
    return f"({log_factorials(n)} - {log_factorials(k, f'{n} - {k}')})"


def hypergeom_sf(universe: str, marked: str, drawn: str, hits: str) -> Column:
    """P(X >= hits) when ``drawn`` of ``universe`` are drawn and ``marked`` of it count; arguments are column names. One exponential
    for the first term; the next terms follow by their ratio.

    Only terms within 10 standard deviations and 60 of the mode, or of hits where that is larger, are added: beyond, they are under
    1e-17 of the sum. So a row takes some hundred steps where the groups have millions of members.
    """
    mean = f"(cast({drawn} as double) * {marked} / {universe})"
    near = f"cast(10 * sqrt({mean} * (1 - cast({marked} as double) / {universe}) * (1 - cast({drawn} as double) / {universe})) + 60 as bigint)"
    least, most = f"greatest({hits}, {drawn} + {marked} - {universe}, 0)", f"least({marked}, {drawn})"
    low = f"greatest({least}, least({most}, cast({mean} as bigint) - {near}))"
    top = f"least({most}, greatest({least}, cast({mean} as bigint)) + {near})"
    up = log_factorials(marked, f"{universe} - {marked}", drawn, f"{universe} - {drawn}")
    down = log_factorials(universe, "low", f"{marked} - low", f"{drawn} - low", f"{universe} - {marked} - {drawn} + low")
    step = f"acc.term * ({marked} - i) * ({drawn} - i) / ((i + 1) * cast({universe} - {marked} - {drawn} + i + 1 as double))"
    # The ends and the first term as lambdas' variables, so that each is computed once.
    walk = f"""aggregate(sequence(low, top - 1), named_struct('term', head, 'total', head),
        (acc, i) -> named_struct('term', {step}, 'total', acc.total + {step}), acc -> acc.total)"""
    summed = f"aggregate(array(exp({up} - {down})), 0D, (zero, head) -> CASE WHEN low >= top THEN head ELSE {walk} END)"
    total = f"aggregate(array({top}), 0D, (a, top) -> aggregate(array({low}), 0D, (b, low) -> {summed}))"
    return F.expr(f"CASE WHEN {hits} <= 0 THEN 1D WHEN {least} > {most} THEN 0D ELSE least(1D, {total}) END")


def with_tail(rows: DataFrame, universe: str, marked: str, drawn: str, hits: str, name: str = "p_value") -> DataFrame:
    """Adds the tail, computed once for each distinct combination of the four counts."""
    keys = [universe, marked, drawn, hits]
    tails = rows.select(*keys).distinct().withColumn(name, hypergeom_sf(*keys))
    return rows.join(tails, keys)


def benjamini_hochberg(rows: DataFrame, p: str, within: list[str], tie: list[str], name: str = "fdr") -> DataFrame:
    """Adds the adjusted p: the running minimum of p * m / rank from the largest p on, in each group of ``within``; without, in one
    partition that has a row for each tested group of the one set."""
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(1))
    up = group.orderBy(p, *tie)
    down = group.orderBy(F.desc("_rank")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = rows.withColumn("_rank", F.row_number().over(up)).withColumn("_m", F.count("*").over(group))
    return ranked.withColumn(name, F.least(F.lit(1.0), F.min(F.col(p) * F.col("_m") / F.col("_rank")).over(down))).drop("_rank", "_m")


def min_max(c: str, within: list[str]) -> Column:
    """c between its least and largest of the group as 0 to 1; 1 where all are (nearly) equal."""
    w = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(1))
    low, high = F.min(c).over(w), F.max(c).over(w)
    equal = high - low <= 1e-9 * F.greatest(F.abs(high), F.abs(low))
    return F.when(equal, 1.0).otherwise((F.col(c) - low) / (high - low))


#: Weights of the final score; the floor of logarithms; what makes a set small.
WEIGHTS = {"enrichment": 0.55, "coverage": 0.30, "mapping": 0.15}
LOG_FLOOR = 1e-300
SMALL_UNIVERSE, SMALL_SET = 10, 3
CONFIDENCE = {"high": 2, "medium": 1, "low": 0}


def confidence(hits: Column, fdr: Column) -> Column:
    return F.when((hits >= 3) & (fdr < 0.01), "high").when((hits >= 2) & (fdr < 0.05), "medium").otherwise("low")


def match_priority(match_type: Column) -> Column:
    found = F.lit(0)
    for name, order in C.MATCH_TYPE_PRIORITY.items():
        found = F.when(match_type == name, order).otherwise(found)
    return found


def best_targets(targets: DataFrame, within: list[str], order: list[str]) -> DataFrame:
    """One row for each set and member: the highest match_score, then the match type that ranks first, then ``order``."""
    w = Window.partitionBy(*within, "member").orderBy(F.desc("match_score"), F.desc(match_priority(F.col("match_type"))), *order)
    return targets.withColumn("_place", F.row_number().over(w)).filter("_place = 1").drop("_place")


def over_representation(membership: DataFrame, targets: DataFrame, min_hits: int = 2, within: list[str] | None = None) -> DataFrame:
    """Enrichment of groups in target sets.

    membership: group_id, member. targets: member, the set columns named in within (none: one set), and, for resolved names, match_type,
    match_score and name; without these every target is a direct match of score 1. Counts: n_universe (distinct members), n_group,
    n_target (targets in the universe), n_hits. Groups of fewer than min_hits hits leave before the false discovery rate is adjusted.
    All counts are aggregations with partial sums; each set's groups are ranked in its own partition.

    The score is .55 of the enrichment (log2, at least 0, between the set's least and largest), .30 of the coverage and .15 of the
    mean match score. baseline_rank orders by confidence, score, false discovery rate, hits and group.
    """
    within = within or []
    if "match_score" not in targets.columns:
        targets = targets.withColumns({"match_type": F.lit("direct"), "match_score": F.lit(1.0), "name": F.col("member").cast("string")})
    members = membership.filter("group_id is not null and member is not null").dropDuplicates(["group_id", "member"]).select("group_id", "member")
    universe = members.agg(F.count_distinct("member").alias("n_universe"))
    groups = members.groupBy("group_id").agg(F.count("*").alias("n_group"))
    order = ["name"] + (["input_order"] if "input_order" in targets.columns else [])
    aimed = best_targets(targets.filter("member is not null"), within, order[::-1]).join(members.select("member").distinct(), "member", "left_semi")
    sizes = aimed.groupBy(*within).agg(F.count("*").alias("n_target")) if within else aimed.agg(F.count("*").alias("n_target"))
    of_type = {"direct": "direct", "fuzzy": "fuzzy", "recovered": "recovered_from_chebi", "exact_structure": "exact_structure", "structural_neighbor": "structural_neighbor"}
    hits = (
        aimed.join(members, "member")
        .groupBy(*within, "group_id")
        .agg(
            F.count("*").alias("n_hits"),
            F.min("match_score").alias("mapping_min"),
            F.max("match_score").alias("mapping_max"),
            *[F.count_if(F.col("match_type") == t).alias(f"n_{n}") for n, t in of_type.items()],
            F.array_sort(F.collect_list(F.struct(F.col("member").cast("string").alias("id"), "name", "match_score"))).alias("_hits"),
        )
        .filter(F.col("n_hits") >= min_hits)
        # The mean is summed in order of the ids, so that its last digit doesn't depend on the plan.
        .withColumns({"hit_ids": F.col("_hits.id"), "hit_names": F.col("_hits.name"), "mapping_mean": F.aggregate("_hits", F.lit(0.0), lambda a, h: a + h["match_score"]) / F.col("n_hits")})
        .drop("_hits")
    )
    # One row of two counts: its size is fixed.
    rows = hits.join(groups, "group_id").crossJoin(F.broadcast(universe))
    rows = rows.join(sizes, within) if within else rows.crossJoin(F.broadcast(sizes))
    rows = rows.filter("n_group > 0 and n_target > 0")
    names = ("n_universe", "n_group", "n_target", "n_hits")
    n, k, d, x = map(F.col, names)
    rows = rows.withColumns({"target_rate": x / d, "background_rate": k / n, "expected": d * k / n, "coverage": x / k})
    rows = rows.withColumns({"excess": x - F.col("expected"), "enrichment": F.col("target_rate") / F.col("background_rate")})
    rows = benjamini_hochberg(with_tail(rows, *names), "p_value", within, ["group_id"])
    rows = rows.withColumns({"log_p": -F.log10(F.greatest("p_value", F.lit(LOG_FLOOR))), "log_fdr": -F.log10(F.greatest("fdr", F.lit(LOG_FLOOR))), "log_ef": F.log2(F.greatest("enrichment", F.lit(1.0)))})
    rows = rows.withColumn("ef_norm", min_max("log_ef", within))
    score = WEIGHTS["enrichment"] * F.col("ef_norm") + WEIGHTS["coverage"] * F.col("coverage") + WEIGHTS["mapping"] * F.col("mapping_mean")
    rows = rows.withColumn("score", exact_round(score)).withColumn("confidence", confidence(x, F.col("fdr")))
    level = F.when(F.col("confidence") == "high", 2).when(F.col("confidence") == "medium", 1).otherwise(0)
    w = (Window.partitionBy(*within) if within else Window.partitionBy(F.lit(1))).orderBy(F.desc(level), F.desc("score"), F.desc("log_fdr"), F.desc("n_hits"), "group_id")
    return rows.withColumn("baseline_rank", F.row_number().over(w)).drop("log_ef")
