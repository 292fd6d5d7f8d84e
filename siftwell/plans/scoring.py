"""Queries on enrichment, ranking, scoring and evaluation, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import stats
from ..functions.numbers import exact_round_sql, scaled_round
from ..operators import evaluate as E
from ..operators import resolve as R
from ..operators import select as S
from . import build


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _placed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with ``place``, the order of its rows: by path of their file, then as they are in it."""
    rows = _t(spark, sf_dir, name)
    if len(rows.inputFiles()) < 2:
        return rows.select("*", F.col("_metadata.row_index").alias("place"))
    path = F.url_decode(F.replace(F.col("_file"), F.lit("+"), F.lit("%2B")))
    files = rows.select(F.col("_metadata.file_path").alias("_file")).distinct().select("_file", F.row_number().over(Window.orderBy(path)).cast("long").alias("_n"))
    placed = rows.select("*", F.col("_metadata.row_index").alias("_row"), F.col("_metadata.file_path").alias("_file"))
    return placed.join(F.broadcast(files), "_file").withColumn("place", F.shiftleft("_n", 40) + F.col("_row")).drop("_file", "_n", "_row")


_COUNTS = ["n_universe", "n_group", "n_target", "n_hits"]
_REALS = ["target_rate", "background_rate", "expected", "excess", "enrichment", "coverage", "p_value", "fdr", "log_p", "log_fdr", "mapping_mean", "mapping_min", "mapping_max", "score"]
_TYPES = ["n_direct", "n_fuzzy", "n_recovered", "n_exact_structure", "n_structural_neighbor"]


def _shown(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(*keys, *_COUNTS, *[F.round(c, 6).alias(c) for c in _REALS], *_TYPES, "confidence", F.array_join("hit_ids", ";").alias("hit_ids"), F.col("baseline_rank").cast("long").alias("baseline_rank"))


def _as_targets(lines: DataFrame, *keys) -> DataFrame:
    """Lines as resolved names: the return flag is the kind of match, the discount what its score lacks."""
    kind = F.when(F.col("l_returnflag") == "R", "fuzzy").when(F.col("l_returnflag") == "A", "exact_structure").otherwise("direct")
    return lines.select(*keys, F.col("l_partkey").alias("member"), kind.alias("match_type"), (1 - F.col("l_discount")).alias("match_score"), F.col("l_partkey").cast("string").alias("name"))


def set_enrichment(spark, d):
    membership = _t(spark, d, "part").select(F.col("p_brand").alias("group_id"), F.col("p_partkey").alias("member"))
    bought = _t(spark, d, "orders").filter("o_custkey < 3").join(_t(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return _shown(stats.over_representation(membership, _as_targets(bought)), ["group_id"])


def enrichment_multi_set(spark, d):
    membership = _t(spark, d, "part").select(F.col("p_brand").alias("group_id"), F.col("p_partkey").alias("member"))
    targets = _as_targets(_t(spark, d, "lineitem"), F.col("l_suppkey").alias("set_id"))
    return _shown(stats.over_representation(membership, targets, within=["set_id"]), ["set_id", "group_id"])


def go_like_enrichment(spark, d):
    """Part types as terms; each nation's suppliers' returned parts as a gene set; sets of under 3 leave; best 5 terms each."""
    part, line, supplier = _t(spark, d, "part"), _t(spark, d, "lineitem"), _t(spark, d, "supplier")
    membership = part.select(F.concat_ws("/", "p_type", "p_size").alias("group_id"), F.col("p_partkey").alias("member"))
    sets = line.filter("l_returnflag = 'R'").join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("set_id"), F.col("l_partkey").alias("member")).distinct()
    big = sets.groupBy("set_id").agg(F.count("*").alias("n")).filter("n >= 3").select("set_id")
    rows = stats.over_representation(membership, sets.join(big, "set_id"), min_hits=1, within=["set_id"])
    rows = rows.select("set_id", "group_id", *_COUNTS, F.round("p_value", 6).alias("p_value"), F.round("fdr", 6).alias("fdr"))
    return S.top_per_group(rows, ["set_id"], [F.asc("p_value"), F.asc("group_id")], 5).withColumn("rank", F.col("rank").cast("long"))


def best_per_group(spark, d):
    return S.best_per_group(_t(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


def topk_per_group(spark, d):
    rows = _t(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    return S.top_per_group(rows, ["l_suppkey"], order, 3).withColumn("rank", F.col("rank").cast("long"))


def rank_with_gap(spark, d):
    rows = _t(spark, d, "orders").select("o_custkey", "o_orderkey", (F.round(F.least(F.col("o_totalprice") / 500000, F.lit(1.0)), 4)).alias("score"), (F.col("o_orderstatus") == "P").alias("direct"))
    return S.select_candidates(rows, ["o_custkey"], "score", "direct", ["o_orderkey"]).select("o_custkey", "o_orderkey", "score", "direct", F.col("rank").cast("long").alias("rank"), "n_candidates")


def coverage_status(spark, d):
    orders = _t(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("k"))
    rows = _t(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return S.coverage(rows, F.when(F.col("k").isNull(), "unmatched").when(F.col("k") > 10, "many").otherwise("matched")).withColumn("percent", F.round("percent", 6))


def evidence_merge(spark, d):
    rows = _placed(spark, d, "lineitem").select("l_partkey", "place", (1 - F.col("l_discount")).alias("score"), F.col("l_linestatus").alias("method"), (F.col("l_returnflag") == "R").alias("direct"), F.concat("l_returnflag", F.lit("-"), F.col("l_linenumber").cast("string")).alias("reason"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    merged = S.merge_evidence(rows, ["l_partkey"], "score", "method", "direct", "reason", "seq", "place")
    return merged.select("l_partkey", "n_evidence", scaled_round(F.col("best_score")).alias("best_score"), "best_method", "any_direct", *[F.when(F.exists(c, lambda x: x.isNotNull()), F.array_join(c, ";")).alias(c) for c in ("methods", "reasons")])


def profile_counts(spark, d):
    return S.profile(_t(spark, d, "events").withColumn("e", F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))), "e")


def all_pairs_alignment(spark, d):
    """Nations' parts aligned with brands' parts: a weighted sum, best 5 brands of each nation by a full order."""
    line = _t(spark, d, "lineitem").join(_t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select("s_nationkey", F.col("l_partkey").alias("member")).distinct()
    brand = _t(spark, d, "part").select("p_brand", F.col("p_partkey").alias("member"))
    rows = R.shared_members(line, "s_nationkey", brand, "p_brand", "member")
    score = F.round(4 * F.col("jaccard") + 3 * F.col("overlap") + F.when(F.col("n_common") > 1, 1.0).otherwise(0.0), 6)
    rows = rows.select("s_nationkey", "p_brand", "n_common", score.alias("score"))
    return S.top_per_group(rows, ["s_nationkey"], [F.desc("score"), F.desc("n_common"), F.asc("p_brand")], 5).withColumn("rank", F.col("rank").cast("long")).withColumn("level", R.score_band(F.col("score"), 6, 4))


def weighted_score_clamp(spark, d):
    agg = _t(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), F.avg("l_discount").alias("discount"), F.count_distinct("l_suppkey").alias("k"))
    most = agg.agg(F.max("n").alias("most_n"), F.max("k").alias("most_k"))
    rows = agg.crossJoin(F.broadcast(most)).join(_t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    raw = 0.30 * F.col("n") / F.col("most_n") + 0.12 * (1 - F.col("discount")) + 0.12 * F.log1p("k") / F.log1p("most_k") + F.least(F.lit(0.05), 0.02 * F.log1p("n")) + F.when(F.col("p_size") > 40, -0.5).otherwise(0.5)
    return rows.select("p_partkey", F.round(R.clamp(raw), 6).alias("score"), R.score_band(R.clamp(raw), 0.65, 0.35).alias("level"))


def ndcg_mrr_recall(spark, d):
    """Customers as samples: their urgent orders should be the dear ones."""
    rows = _t(spark, d, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("label"), F.floor(F.col("o_totalprice") / 50000).cast("double").alias("score"))
    got = E.rank_metrics(rows, "o_custkey", "score", "label", ["o_orderkey"])
    return got.select("n_samples", *[F.round(c, 6).alias(c) for c in got.columns if c != "n_samples"])


def overlap_leakage(spark, d):
    o = _t(spark, d, "orders")
    got = E.leakage(o.filter("o_orderkey % 5 <> 0"), o.filter("o_orderkey % 5 = 0"), ["o_custkey"])
    return got.withColumn("shared_ratio", F.round("shared_ratio", 6))


def cv_summary(spark, d):
    rows = E.summary(_t(spark, d, "orders"), ["o_orderpriority"], "o_totalprice")
    return rows.select("o_orderpriority", *[F.round(c, 4).alias(c) for c in ("mean", "std", "least", "most")])


def weighted_average(spark, d):
    rows = E.weighted_mean(_t(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_discount", "l_quantity")
    return rows.withColumn("weighted_mean", F.round("weighted_mean", 6))


def percentiles(spark, d):
    got = E.percentiles(_t(spark, d, "lineitem"), "l_extendedprice", [0.5, 0.9, 0.95, 0.99])
    return got.select(*[F.round(c, 4).alias(c) for c in got.columns])


def json_contributions(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    return _t(spark, d, "events").select("event_id", F.to_json(F.struct(F.col("event_type").alias("kind"), F.coalesce(k, F.lit(0)).alias("k"))).alias("contributions"))


def min_max_norm(spark, d):
    """Balances between the least and most of their segment."""
    c = _t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return c.select("c_custkey", F.round(stats.min_max("c_acctbal", ["c_mktsegment"]), 6).alias("norm"))


def pathway_score(spark, d):
    """The thirteen contributions and their score, over parts whose columns stand for a pathway's evidence."""
    line = _t(spark, d, "lineitem").groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("compound_count"), F.count_distinct("l_orderkey").alias("gene_count"))
    rows = _t(spark, d, "part").join(line, F.col("p_partkey") == F.col("l_partkey"))
    k = F.col("p_partkey")
    rows = rows.select(
        "p_partkey", "compound_count", "gene_count", (F.col("p_size") / 50).alias("match_score"), (k % 2 == 0).alias("chebi_xref_direct"), (k % 3 == 0).alias("structure_validated"),
        F.when(k % 4 > 0, F.array(F.lit("EC"))).otherwise(F.array().cast("array<string>")).alias("ec_numbers"), (k % 5).alias("reaction_count"), (k % 7 == 0).alias("cofactor_like"), (k % 11 < 4).alias("plantcyc_corroboration"),
        F.when(k % 13 < 4, "high").when(k % 13 < 8, "medium").otherwise("").alias("plant_reactome_alignment_confidence"), F.when(k % 17 < 5, "term").otherwise("").alias("go_best_term"),
        F.when(k % 19 < 5, "high").when(k % 19 < 12, "medium").otherwise("low").alias("annotation_confidence"),
    )
    scored = build.score(rows)
    return scored.select("p_partkey", F.round("score", 6).alias("score"), "confidence_level", F.round("contributions.gene_support", 4).alias("gene_support"), F.round("contributions.pathway_specificity", 4).alias("pathway_specificity"))


QUERIES = {f.__name__: f for f in (
    set_enrichment, enrichment_multi_set, go_like_enrichment, best_per_group, topk_per_group, rank_with_gap, coverage_status, evidence_merge, profile_counts, all_pairs_alignment, weighted_score_clamp,
    ndcg_mrr_recall, overlap_leakage, cv_summary, weighted_average, percentiles, json_contributions, min_max_norm, pathway_score,
)}


def _enriched(membership: str, targets: str, keys: str, min_hits: int) -> str:
    """Common tables of an enrichment over membership(group_id, member) and targets(keys..., member, match_type, match_score)."""
    part = f"PARTITION BY {keys}" if keys else ""
    also = f"{keys}, " if keys else ""
    size_join = f"JOIN sizes USING ({keys})" if keys else "CROSS JOIN sizes"
    return f"""WITH m AS (SELECT DISTINCT group_id, member FROM ({membership}) WHERE group_id IS NOT NULL AND member IS NOT NULL),
 u AS (SELECT count(DISTINCT member) AS n_universe FROM m), g AS (SELECT group_id, count(*) AS n_group FROM m GROUP BY 1),
 t AS (SELECT * FROM ({targets}) WHERE member IN (SELECT member FROM m)
       QUALIFY row_number() OVER (PARTITION BY {also}member ORDER BY match_score DESC, CASE match_type WHEN 'direct' THEN 5 WHEN 'exact_structure' THEN 4 WHEN 'fuzzy' THEN 3 ELSE 0 END DESC) = 1),
 sizes AS (SELECT {also}count(*) AS n_target FROM t {f'GROUP BY {keys}' if keys else ''}),
 h AS (SELECT {also}group_id, count(*) AS n_hits, list_sum(list(match_score ORDER BY CAST(member AS VARCHAR))) / count(*) AS mapping_mean, min(match_score) AS mapping_min, max(match_score) AS mapping_max, count(*) FILTER (WHERE match_type = 'direct') AS n_direct,
         count(*) FILTER (WHERE match_type = 'fuzzy') AS n_fuzzy, count(*) FILTER (WHERE match_type = 'recovered_from_chebi') AS n_recovered, count(*) FILTER (WHERE match_type = 'exact_structure') AS n_exact_structure,
         count(*) FILTER (WHERE match_type = 'structural_neighbor') AS n_structural_neighbor, string_agg(CAST(member AS VARCHAR), ';' ORDER BY CAST(member AS VARCHAR)) AS hit_ids
       FROM t JOIN m USING (member) GROUP BY {also}group_id HAVING count(*) >= {min_hits}),
 r AS (SELECT * FROM h JOIN g USING (group_id) CROSS JOIN u {size_join}),
 p AS (SELECT *, n_hits / CAST(n_target AS DOUBLE) AS target_rate, n_group / CAST(n_universe AS DOUBLE) AS background_rate, n_target * n_group / CAST(n_universe AS DOUBLE) AS expected,
   n_hits - n_target * n_group / CAST(n_universe AS DOUBLE) AS excess, (n_hits / CAST(n_target AS DOUBLE)) / (n_group / CAST(n_universe AS DOUBLE)) AS enrichment, n_hits / CAST(n_group AS DOUBLE) AS coverage,
   least(1.0, list_sum(list_transform(range(n_hits, least(n_group, n_target) + 1), lambda i: CASE WHEN n_target - i > n_universe - n_group THEN 0.0 ELSE
     exp(lgamma(n_group + 1) - lgamma(i + 1) - lgamma(n_group - i + 1) + lgamma(n_universe - n_group + 1) - lgamma(n_target - i + 1) - lgamma(n_universe - n_group - n_target + i + 1)
       - lgamma(n_universe + 1) + lgamma(n_target + 1) + lgamma(n_universe - n_target + 1)) END))) AS p_value FROM r),
 k AS (SELECT *, row_number() OVER ({part} ORDER BY p_value, group_id) AS rk, count(*) OVER ({part}) AS m FROM p),
 f AS (SELECT *, least(1.0, min(p_value * m / rk) OVER ({part} ORDER BY rk DESC ROWS UNBOUNDED PRECEDING)) AS fdr FROM k),
 l AS (SELECT *, -log10(greatest(p_value, 1e-300)) AS log_p, -log10(greatest(fdr, 1e-300)) AS log_fdr, log2(greatest(enrichment, 1.0)) AS le FROM f),
 w AS (SELECT *, min(le) OVER ({part}) AS e0, max(le) OVER ({part}) AS e1 FROM l),
 n AS (SELECT *, {exact_round_sql('0.55 * CASE WHEN e1 - e0 <= 1e-9 * e1 THEN 1.0 ELSE (le - e0) / (e1 - e0) END + 0.30 * coverage + 0.15 * mapping_mean')} AS score,
   CASE WHEN n_hits >= 3 AND fdr < 0.01 THEN 'high' WHEN n_hits >= 2 AND fdr < 0.05 THEN 'medium' ELSE 'low' END AS confidence FROM w),
 s AS (SELECT *, row_number() OVER ({part} ORDER BY CASE confidence WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END DESC, score DESC, log_fdr DESC, n_hits DESC, group_id) AS baseline_rank FROM n)
"""


_OUT = ", ".join(_COUNTS) + ", " + ", ".join(f"round({c}, 6) AS {c}" for c in _REALS) + ", " + ", ".join(_TYPES) + ", confidence, hit_ids, baseline_rank FROM s"
_BRANDS = "SELECT p_brand AS group_id, p_partkey AS member FROM part"
_AS_TARGETS = "l_partkey AS member, CASE l_returnflag WHEN 'R' THEN 'fuzzy' WHEN 'A' THEN 'exact_structure' ELSE 'direct' END AS match_type, 1 - l_discount AS match_score"

SQL = {
    "set_enrichment": _enriched(_BRANDS, f"SELECT {_AS_TARGETS} FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey < 3", "", 2) + f"SELECT group_id, {_OUT}",
    "enrichment_multi_set": _enriched(_BRANDS, f"SELECT l_suppkey AS set_id, {_AS_TARGETS} FROM lineitem", "set_id", 2) + f"SELECT set_id, group_id, {_OUT}",
    "go_like_enrichment": _enriched(
        "SELECT p_type || '/' || p_size AS group_id, p_partkey AS member FROM part",
        "SELECT *, 'direct' AS match_type, 1.0 AS match_score FROM (SELECT DISTINCT s_nationkey AS set_id, l_partkey AS member FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R') QUALIFY count(*) OVER (PARTITION BY set_id) >= 3",
        "set_id", 1,
    ) + "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY set_id ORDER BY p_value, group_id) AS rank FROM (SELECT set_id, group_id, n_universe, n_group, n_target, n_hits, round(p_value, 6) AS p_value, round(fdr, 6) AS fdr FROM s)) WHERE rank <= 5",
    "best_per_group": "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1",
    "topk_per_group": "SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r <= 3",
    "rank_with_gap": """WITH x AS (SELECT o_custkey, o_orderkey, round(least(o_totalprice / 500000, 1.0), 4) AS score, o_orderstatus = 'P' AS direct FROM orders),
        y AS (SELECT *, row_number() OVER w AS rank, score - lead(score) OVER w AS gap, count(*) OVER (PARTITION BY o_custkey) AS n_candidates, bool_or(direct) OVER (PARTITION BY o_custkey) AS d FROM x WINDOW w AS (PARTITION BY o_custkey ORDER BY score DESC, o_orderkey))
        SELECT o_custkey, o_orderkey, score, direct, rank, n_candidates FROM y WHERE (d AND direct) OR (NOT d AND rank = 1 AND score >= 0.88 AND (n_candidates = 1 OR score >= 0.96 OR gap >= 0.03))""",
    "coverage_status": """SELECT status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM (SELECT CASE WHEN k IS NULL THEN 'unmatched' WHEN k > 10 THEN 'many' ELSE 'matched' END AS status
        FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1) ON c_custkey = o_custkey) GROUP BY status""",
    "evidence_merge": """WITH x AS (SELECT l_partkey, 1 - l_discount AS score, l_linestatus AS method, l_returnflag = 'R' AS direct, l_returnflag || '-' || l_linenumber AS reason, l_orderkey * 10 + l_linenumber AS seq FROM lineitem),
        f AS (SELECT l_partkey, list(reason ORDER BY q)[1:8] AS rs FROM (SELECT l_partkey, reason, min(seq) AS q FROM x GROUP BY 1, 2) GROUP BY 1)
        SELECT l_partkey, n_evidence, best_score, best_method, any_direct, methods, array_to_string(rs, ';') AS reasons FROM f JOIN (
        SELECT l_partkey, count(*) AS n_evidence, round(max(score), 6) AS best_score, (min(struct_pack(s := -score, q := seq, m := method))).m AS best_method, bool_or(direct) AS any_direct,
        array_to_string(list_sort(list(DISTINCT method)), ';') AS methods FROM x GROUP BY l_partkey) USING (l_partkey)""",
    "profile_counts": "SELECT CASE WHEN event_type = 'view' THEN '<empty>' ELSE coalesce(event_type, '<empty>') END AS value, count(*) AS n FROM events GROUP BY 1",
    "all_pairs_alignment": """WITH a AS (SELECT DISTINCT s_nationkey, l_partkey AS member FROM lineitem JOIN supplier ON l_suppkey = s_suppkey), b AS (SELECT p_brand, p_partkey AS member FROM part),
        j AS (SELECT * FROM (SELECT s_nationkey, p_brand, count(*) AS n_common FROM a JOIN b USING (member) GROUP BY 1, 2) JOIN (SELECT s_nationkey, count(*) AS n_a FROM a GROUP BY 1) USING (s_nationkey) JOIN (SELECT p_brand, count(*) AS n_b FROM b GROUP BY 1) USING (p_brand)),
        s AS (SELECT s_nationkey, p_brand, n_common, round(4 * (n_common / CAST(n_a + n_b - n_common AS DOUBLE)) + 3 * (n_common / CAST(least(n_a, n_b) AS DOUBLE)) + CASE WHEN n_common > 1 THEN 1.0 ELSE 0.0 END, 6) AS score FROM j)
        SELECT *, CASE WHEN score >= 6 THEN 'high' WHEN score >= 4 THEN 'medium' ELSE 'low' END AS level FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY score DESC, n_common DESC, p_brand) AS rank FROM s) WHERE rank <= 5""",
    "weighted_score_clamp": """WITH a AS (SELECT l_partkey, count(*) AS n, avg(l_discount) AS discount, count(DISTINCT l_suppkey) AS k FROM lineitem GROUP BY 1), mx AS (SELECT max(n) AS mn, max(k) AS mk FROM a),
        r AS (SELECT p_partkey, greatest(0.0, least(0.999, 0.30 * n / mn + 0.12 * (1 - discount) + 0.12 * ln(1 + k) / ln(1 + mk) + least(0.05, 0.02 * ln(1 + n)) + CASE WHEN p_size > 40 THEN -0.5 ELSE 0.5 END)) AS s FROM a, mx, part WHERE l_partkey = p_partkey)
        SELECT p_partkey, round(s, 6) AS score, CASE WHEN s >= 0.65 THEN 'high' WHEN s >= 0.35 THEN 'medium' ELSE 'low' END AS level FROM r""",
    "ndcg_mrr_recall": """WITH x AS (SELECT o_custkey AS source, o_orderkey AS doc_id, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS label, floor(o_totalprice / 50000) AS score FROM orders),
        r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rank, row_number() OVER (PARTITION BY source ORDER BY label DESC, doc_id) AS ideal FROM x),
        q AS (SELECT *, avg(CASE WHEN rank <= 5 THEN 1 / log2(rank + 1) ELSE 0 END) OVER (PARTITION BY source, score) AS share FROM r),
        e AS (SELECT source, sum(label * share) / sum(CASE WHEN ideal <= 5 THEN label / log2(ideal + 1) ELSE 0 END) AS ndcg, max(CASE WHEN label > 0 THEN 1.0 / rank ELSE 0 END) AS mrr, sum(CASE WHEN label > 0 THEN 1 ELSE 0 END) AS p,
          sum(CASE WHEN label > 0 AND rank <= 1 THEN 1.0 ELSE 0 END) AS r1, sum(CASE WHEN label > 0 AND rank <= 3 THEN 1.0 ELSE 0 END) AS r3, sum(CASE WHEN label > 0 AND rank <= 5 THEN 1.0 ELSE 0 END) AS r5 FROM q GROUP BY source)
        SELECT count(*) AS n_samples, round(avg(ndcg), 6) AS ndcg, round(avg(CAST(mrr AS DOUBLE)), 6) AS mrr, round(avg(CAST(r1 / p AS DOUBLE)), 6) AS recall_1, round(avg(CAST(r3 / p AS DOUBLE)), 6) AS recall_3, round(avg(CAST(r5 / p AS DOUBLE)), 6) AS recall_5 FROM e WHERE p > 0""",
    "overlap_leakage": """WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 5 = 0), s AS (SELECT o_custkey FROM a INTERSECT SELECT o_custkey FROM b)
        SELECT n_train, n_test, n_shared, round(n_shared / CAST(n_test AS DOUBLE), 6) AS shared_ratio FROM (SELECT (SELECT count(*) FROM a) AS n_train, (SELECT count(*) FROM b) AS n_test, (SELECT count(*) FROM s) AS n_shared)""",
    "cv_summary": "SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, round(min(o_totalprice), 4) AS least, round(max(o_totalprice), 4) AS most FROM orders GROUP BY 1",
    "weighted_average": "SELECT l_returnflag, l_linestatus, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS weighted_mean FROM lineitem GROUP BY 1, 2",
    "percentiles": "SELECT " + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 4) AS p{round(p * 100)}" for p in (0.5, 0.9, 0.95, 0.99)) + " FROM lineitem",
    "json_contributions": """SELECT event_id, '{"kind":"' || event_type || '","k":' || coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) || '}' AS contributions FROM events""",
    "min_max_norm": """SELECT c_custkey, round(CASE WHEN hi > lo THEN (c_acctbal - lo) / (hi - lo) ELSE 1.0 END, 6) AS norm FROM (SELECT *, min(c_acctbal) OVER (PARTITION BY c_mktsegment) AS lo, max(c_acctbal) OVER (PARTITION BY c_mktsegment) AS hi FROM customer)""",
    "pathway_score": f"""WITH a AS (SELECT l_partkey, count(DISTINCT l_suppkey) AS c, count(DISTINCT l_orderkey) AS g FROM lineitem GROUP BY 1), m AS (SELECT max(c) AS mc, max(g) AS mg FROM a),
        r AS (SELECT p_partkey AS k, p_size / 50.0::DOUBLE AS s, c, g, mc, mg FROM part JOIN a ON p_partkey = l_partkey CROSS JOIN m),
        t AS (SELECT k, s, g, {exact_round_sql('0.30::DOUBLE * s')} AS t1, {exact_round_sql('0.12::DOUBLE * (ln(1 + g) / ln(1 + mg))')} AS t4, {exact_round_sql('0.10::DOUBLE * (1 - ln(1 + c) / ln(1 + mc))')} AS t5,
              {exact_round_sql('least(0.05::DOUBLE, 0.02::DOUBLE * ln(1 + k % 5))')} AS t8 FROM r),
        z AS (SELECT *, greatest(0.0, least(0.999::DOUBLE, t1 + CASE WHEN k % 2 = 0 THEN 0.12 ELSE 0 END::DOUBLE + CASE WHEN k % 3 = 0 THEN 0.08 ELSE 0 END::DOUBLE + t4 + t5 + CASE WHEN k % 4 > 0 THEN 0.06 ELSE 0 END::DOUBLE
              + CASE WHEN k % 5 > 0 THEN 0.04 ELSE 0 END::DOUBLE + t8 + CASE WHEN k % 7 = 0 THEN -0.12 ELSE 0 END::DOUBLE + CASE WHEN k % 11 < 4 THEN 0.05 ELSE 0 END::DOUBLE
              + CASE WHEN k % 13 < 4 THEN 0.03 WHEN k % 13 < 8 THEN 0.015 ELSE 0 END::DOUBLE + CASE WHEN k % 17 < 5 THEN 0.02 ELSE 0 END::DOUBLE + CASE WHEN k % 19 < 5 THEN 0.03 WHEN k % 19 < 12 THEN 0.015 ELSE 0 END::DOUBLE)) AS score FROM t)
        SELECT k AS p_partkey, round(score, 6) AS score, CASE WHEN score >= 0.65 AND g > 0 AND s >= 0.90 THEN 'high' WHEN score >= 0.35 THEN 'medium' ELSE 'low' END AS confidence_level, round(t4, 4) AS gene_support, round(t5, 4) AS pathway_specificity FROM z""",
}
