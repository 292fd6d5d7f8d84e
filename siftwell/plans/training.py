"""Learning to rank enriched pathways: samples of compound sets, their candidate pathways with features, folds, a model and its measures.

The ranker is a pointwise logistic regression on standardised features (``recall.fit``): there is no pairwise tree learner in Spark, and
figures of one can't be compared with it. Its scores are sums of contributions, so an explanation of a row is exact.
"""

from __future__ import annotations

import itertools
import json
import math
import zlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import stats
from ..functions import text as T
from ..functions.numbers import exact_round
from ..operators import evaluate as E
from ..operators import select as S
from ..operators.lineage import cut
from ..sinks import tables as W
from ..sources import readers
from ..sources.paths import exists
from . import recall
from .query import Engine, set_features

#: Seed, shares and limits of training.
SEED, TRAIN_SHARE, FOLDS, NEGATIVES, HARD, SUBSETS, LARGEST, LABELS = 42, 0.80, 5, 30, 20, 50, 10, 5
MODEL_KIND = "logistic_pointwise"
#: Features of a candidate and of its set, in the order a model sees them.
ROW_FEATURES = {
    "baseline_score": "score", "x_i": "n_hits", "K_i": "n_group", "n": "n_target", "N": "n_universe", "query_coverage": "target_rate", "pathway_coverage": "coverage", "background_rate": "background_rate",
    "expected_hits": "expected", "excess_hits": "excess", "EF": "enrichment", "p_value": "p_value", "FDR": "fdr", "neg_log10_p": "log_p", "neg_log10_fdr": "log_fdr", "mapping_confidence_mean": "mapping_mean",
    "mapping_confidence_min": "mapping_min", "mapping_confidence_max": "mapping_max", "direct_hit_count": "n_direct", "fuzzy_hit_count": "n_fuzzy", "recovered_hit_count": "n_recovered",
    "exact_structure_hit_count": "n_exact_structure", "structural_neighbor_hit_count": "n_structural_neighbor",
}
SET_FEATURES = ["set_size", "pairwise_tanimoto_mean", "pairwise_tanimoto_max", "pairwise_tanimoto_min", "ontology_diversity", "formula_diversity", "charge_diversity"]
#: Features under names of our own: n and N are one name to Spark.
FEATURES = [*ROW_FEATURES.values(), *SET_FEATURES]


def subset_rows(members: list[str], limit: int, seed: int) -> list[tuple[str, ...]]:
    """All subsets of 2 to 10 members if there are at most ``limit``; else that many different ones, of a size as likely as it has
    subsets, from a generator seeded by the members' pathway."""
    ordered = sorted(set(members))
    sizes = {k: math.comb(len(ordered), k) for k in range(2, min(LARGEST, len(ordered)) + 1)}
    if sum(sizes.values()) <= limit:
        return [c for k in sizes for c in itertools.combinations(ordered, k)]
    rng, found = np.random.default_rng(seed), set()
    share = np.array([float(v) for v in sizes.values()])
    share /= share.sum()
    for _ in range(100 * limit):
        k = int(rng.choice(list(sizes), p=share))
        found.add(tuple(ordered[i] for i in sorted(rng.choice(len(ordered), k, replace=False))))
        if len(found) == limit:
            break
    return sorted(found)


def subsets(members: DataFrame, prefix: str, limit: int = SUBSETS, seed: int = SEED) -> DataFrame:
    """sample_id, seed_pathway, member: up to ``limit`` subsets of each pathway. members: pathway_id, member. A pathway's members are
    one group, as a pathway is small; its generator depends on the seed and the pathway alone, not on the partitioning."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        pathway = group["pathway_id"].iloc[0]
        rows = subset_rows(group["member"].tolist(), limit, seed ^ zlib.crc32(pathway.encode()))
        return pd.DataFrame([(f"{prefix}_{pathway}_{k:03d}", pathway, m) for k, one in enumerate(rows, 1) for m in one], columns=["sample_id", "seed_pathway", "member"])

    return members.select("pathway_id", "member").distinct().groupBy("pathway_id").applyInPandas(run, "sample_id string, seed_pathway string, member string")


def positives(samples: DataFrame, membership: DataFrame) -> DataFrame:
    """sample_id, pathway_id: pathways that hold every member of a sample (relational division)."""
    size = samples.groupBy("sample_id").agg(F.count_distinct("member").alias("_n"))
    held = samples.select("sample_id", "member").distinct().join(membership.select("pathway_id", "member").distinct(), "member").groupBy("sample_id", "pathway_id").agg(F.count("*").alias("_k"))
    return held.join(size, "sample_id").filter("_k = _n").select("sample_id", "pathway_id")


def split_compounds(members: DataFrame, share: float = TRAIN_SHARE, seed: int = SEED) -> DataFrame:
    """member, split: train or test, exact to one compound, in the order of a seeded hash."""
    each = members.select("member").distinct()
    total = each.count()
    train = total if total <= 1 else max(1, min(total - 1, round(total * share)))
    place = F.row_number().over(Window.orderBy(F.xxhash64(F.lit(seed), "member"), "member"))
    return each.withColumn("split", F.when(place <= train, "train").otherwise("test"))


def generated(membership: DataFrame, split: DataFrame, limit: int = SUBSETS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Samples (sample_id, split, member) of pathways with two compounds on either side, compound-disjoint, and their positives."""
    rows = membership.select("pathway_id", "member").distinct().join(split, "member")
    sides = rows.groupBy("pathway_id").agg(F.count_if(F.col("split") == "train").alias("a"), F.count_if(F.col("split") == "test").alias("b")).filter("a >= 2 and b >= 2").select("pathway_id")
    rows = cut(rows.join(sides, "pathway_id", "left_semi"))
    parts = [subsets(rows.filter(F.col("split") == s), f"aracyc_{s}", limit, seed).withColumn("split", F.lit(s)) for s in ("train", "test")]
    samples = cut(reduce(DataFrame.unionByName, parts))
    return samples, positives(samples, rows)


def deploy_samples(membership: DataFrame, limit: int = SUBSETS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Samples and positives from all compounds of pathways with two or more."""
    rows = membership.select("pathway_id", "member").distinct()
    enough = rows.groupBy("pathway_id").agg(F.count("*").alias("_n")).filter("_n >= 2").select("pathway_id")
    rows = rows.join(enough, "pathway_id", "left_semi")
    samples = cut(subsets(rows, "aracyc_deploy", limit, seed).withColumn("split", F.lit("train")))
    return samples, positives(samples, rows)


def candidates(samples: DataFrame, labels: DataFrame, membership: DataFrame, structures: DataFrame, parents: DataFrame, hard: int = HARD, total: int = NEGATIVES, seed: int = SEED) -> DataFrame:
    """One row for each sample and candidate pathway, with label and all features: the positives, the hardest negatives by the
    baseline, and others by a seeded hash up to ``total``. The false discovery rate is adjusted over a sample's candidates.

    A candidate outside the baseline (fewer than two hits) counts as enriched wholly or not at all in its score.
    """
    groups = membership.select(F.col("pathway_id").alias("group_id"), "member")
    base = stats.over_representation(groups, samples.select("sample_id", "member"), within=["sample_id"]).withColumnRenamed("group_id", "pathway_id")
    base = cut(base.drop("hit_ids", "hit_names", "ef_norm", "fdr", "log_fdr", "confidence"))
    labelled = labels.withColumn("label", F.lit(1))
    first = base.join(labels, ["sample_id", "pathway_id"], "left_anti").withColumn("_n", F.row_number().over(Window.partitionBy("sample_id").orderBy("baseline_rank"))).filter(F.col("_n") <= hard).select("sample_id", "pathway_id")
    # A sample draws its other negatives as the next pathways on a ring of hashes from a place of its own on, so no sample is joined
    # with all pathways: enough places are drawn to make up for those it has already.
    ring = groups.select(F.col("group_id").alias("pathway_id")).distinct()
    ring = cut(ring.withColumn("place", F.row_number().over(Window.orderBy(F.xxhash64(F.lit(seed), "pathway_id"), "pathway_id")) - 1))
    size = ring.count()
    taken = labels.select("sample_id", "pathway_id").union(first).distinct()
    have = taken.groupBy("sample_id").agg(F.count("*").alias("_t")).join(first.groupBy("sample_id").agg(F.count("*").alias("_h")), "sample_id", "left").fillna(0, ["_h"])
    asked = samples.select("sample_id").distinct().join(have, "sample_id", "left").fillna(0)
    need = F.greatest(F.lit(0), F.lit(total) - F.col("_h"))
    draws = asked.withColumn("need", need).filter("need > 0").withColumn("k", F.explode(F.sequence(F.lit(0), F.least(F.lit(max(size - 1, 0)), (F.col("need") + F.col("_t")).cast("int")))))
    draws = draws.withColumn("place", F.pmod(F.xxhash64(F.lit(seed), "sample_id") + F.col("k"), F.lit(max(size, 1))).cast("int")).join(ring, "place").join(taken, ["sample_id", "pathway_id"], "left_anti")
    filled = draws.withColumn("_n", F.row_number().over(Window.partitionBy("sample_id").orderBy("k"))).filter("_n <= need").select("sample_id", "pathway_id")
    chosen = taken.union(filled).join(labelled, ["sample_id", "pathway_id"], "left").fillna(0, ["label"])
    rest = single_rows(chosen.join(base.select("sample_id", "pathway_id"), ["sample_id", "pathway_id"], "left_anti").select("sample_id", "pathway_id"), groups, samples)
    rows = chosen.join(base.drop("baseline_rank").unionByName(rest), ["sample_id", "pathway_id"])
    rows = stats.benjamini_hochberg(rows, "p_value", ["sample_id"], ["pathway_id"]).withColumn("log_fdr", -F.log10(F.greatest("fdr", F.lit(stats.LOG_FLOOR))))
    rows = rows.withColumn("confidence", stats.confidence(F.col("n_hits"), F.col("fdr")))
    about = set_features(samples.select("sample_id", F.col("member").alias("compound_id")), structures, parents, ["sample_id"])
    split = samples.select("sample_id", "split").distinct()
    return rows.join(about, "sample_id").join(split, "sample_id").withColumns({c: F.col(c).cast("double") for c in FEATURES})


def single_rows(pairs: DataFrame, groups: DataFrame, samples: DataFrame) -> DataFrame:
    """Statistics of single (sample_id, pathway_id) pairs with any number of hits, every member a direct match of score 1."""
    universe = groups.agg(F.count_distinct("member").alias("n_universe"))
    members = groups.distinct().withColumnRenamed("group_id", "pathway_id")
    sizes = members.groupBy("pathway_id").agg(F.count("*").alias("n_group"))
    aimed = samples.select("sample_id", "member").distinct().join(members.select("member").distinct(), "member", "left_semi")
    targets = aimed.groupBy("sample_id").agg(F.count("*").alias("n_target"))
    hits = pairs.join(members, "pathway_id").join(aimed, ["sample_id", "member"]).groupBy("sample_id", "pathway_id").agg(F.count("*").alias("n_hits"))
    rows = pairs.join(hits, ["sample_id", "pathway_id"], "left").fillna(0, ["n_hits"]).join(sizes, "pathway_id").join(targets, "sample_id").crossJoin(F.broadcast(universe))
    n, k, d, x = map(F.col, ("n_universe", "n_group", "n_target", "n_hits"))
    any_ = F.when(x > 0, 1.0).otherwise(0.0)
    rows = rows.withColumns({"target_rate": x / d, "background_rate": k / n, "expected": d * k / n, "coverage": x / k, "mapping_mean": any_, "mapping_min": any_, "mapping_max": any_, "n_direct": x, **{f"n_{t}": F.lit(0).cast("long") for t in ("fuzzy", "recovered", "exact_structure", "structural_neighbor")}})
    rows = rows.withColumns({"excess": x - F.col("expected"), "enrichment": F.col("target_rate") / F.col("background_rate")})
    rows = stats.with_tail(rows, "n_universe", "n_group", "n_target", "n_hits").withColumn("log_p", -F.log10(F.greatest("p_value", F.lit(stats.LOG_FLOOR))))
    score = stats.WEIGHTS["enrichment"] * F.when(F.col("enrichment") >= 1, 1.0).otherwise(0.0) + stats.WEIGHTS["coverage"] * F.col("coverage") + stats.WEIGHTS["mapping"] * F.col("mapping_mean")
    return rows.withColumn("score", exact_round(score))


def duplicate_ids(rows: DataFrame, key: str = "sample_id") -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def contributions(model: recall.Model, rows: DataFrame) -> DataFrame:
    """rows with contributions: of each feature to the log-odds, against the mean row; they and the mean's log-odds add up to the score."""
    mean, std, coef = model.scaler.mean.toArray(), model.scaler.std.toArray(), model.regression.coefficients.toArray()
    weight = [float(c / s) if s else 0.0 for c, s in zip(coef, std, strict=True)]
    parts = F.map_from_arrays(F.array(*map(F.lit, model.features)), F.array(*[(F.col(f) - F.lit(float(m))) * F.lit(w) for f, m, w in zip(model.features, mean, weight, strict=True)]))
    return rows.withColumn("contributions", parts).withColumns({"top_positive": E.top_labels(F.col("contributions"), LABELS), "top_negative": E.top_labels(F.col("contributions"), LABELS, positive=False)})


def contribution_summary(rows: DataFrame) -> DataFrame:
    """feature, mean_abs, rank over all rows."""
    each = rows.select(F.explode("contributions").alias("feature", "v")).groupBy("feature").agg(F.avg(F.abs("v")).alias("mean_abs"), F.count("*").alias("n_rows"))
    return each.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean_abs"), "feature")))


def importance(model: recall.Model, spark: SparkSession) -> DataFrame:
    """feature and the size of its standardised coefficient, with rank."""
    rows = spark.createDataFrame([(f, abs(float(c))) for f, c in zip(model.features, model.regression.coefficients.toArray(), strict=True)], "feature string, importance double")
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "feature")))


def measures(rows: DataFrame, score: str) -> dict[str, float]:
    found = E.rank_metrics(rows, "sample_id", score, "label", ["pathway_id"]).first().asDict()
    return {k: float(v) if v is not None else 0.0 for k, v in found.items()}


def overlap(samples: DataFrame, labels: DataFrame) -> dict[str, float]:
    """Compounds and pathways that train and test share."""
    side = lambda s: samples.filter(F.col("split") == s)
    own = labels.join(samples.select("sample_id", "split").distinct(), "sample_id")
    out = {}
    for name, a, b, key in (("compound", side("train"), side("test"), "member"), ("pathway", own.filter("split = 'train'"), own.filter("split = 'test'"), "pathway_id")):
        r = E.leakage(a, b, [key]).first()
        out |= {f"shared_{name}_count": r.n_shared, f"shared_{name}_ratio": r.shared_ratio or 0.0}
    return out


def run_split(rows: DataFrame) -> tuple[recall.Model, DataFrame, dict[str, float]]:
    """Fits on train, scores test, and measures both orders."""
    model = recall.fit(rows.filter("split = 'train'"), FEATURES)
    scored = model.score(rows.filter("split = 'test'"))
    found = {f"{who}_{k}": v for who, c in (("baseline", "score"), ("model", "ml_score")) for k, v in measures(scored, c).items()}
    return model, scored, found


def run_folds(engine: Engine, folds: int = FOLDS, limit: int = SUBSETS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """One row of measures for each fold of compounds, and their mean, deviation, least and most."""
    membership = engine.membership.select("pathway_id", "member").distinct()
    parts = E.folds(membership.select("member").distinct(), "member", folds, seed)
    rows = []
    for k in range(folds):
        split = parts.select("member", F.when(F.col("fold") == k, "test").otherwise("train").alias("split"))
        samples, labels = generated(membership, split, limit, seed)
        table = cut(candidates(samples, labels, membership, engine.structures, engine.parents, seed=seed))
        if table.filter("split = 'test'").isEmpty() or table.filter("split = 'train'").select("label").distinct().count() < 2:
            continue
        _, _, found = run_split(table)
        rows.append((k, {**found, **{a: float(b) for a, b in overlap(samples, labels).items()}}))
    flat = engine.spark.createDataFrame([(k, n, v) for k, found in rows for n, v in found.items()], "fold_id int, metric string, value double")
    return flat, E.summary(flat, ["metric"], "value")


def publish(engine: Engine, folder: str, limit: int = SUBSETS, seed: int = SEED) -> recall.Model:
    """Fits on samples of all compounds and writes the model that ``load`` reads."""
    membership = engine.membership.select("pathway_id", "member").distinct()
    samples, labels = deploy_samples(membership, limit, seed)
    table = cut(candidates(samples, labels, membership, engine.structures, engine.parents, seed=seed))
    model = recall.fit(table, FEATURES)
    model.regression.write().overwrite().save(f"{folder}/regression")
    model.scaler.write().overwrite().save(f"{folder}/scaler")
    W.write_json(engine.spark, {"model_kind": MODEL_KIND, "feature_columns": FEATURES, "training_rows": table.count(), "seed": seed}, f"{folder}/metadata.json")
    return model


def load(spark: SparkSession, folder: str) -> tuple[recall.Model | None, str]:
    """The published model, or None and why there is none: online_model_missing, _unreadable or _incompatible."""
    if not all(exists(spark, f"{folder}/{x}") for x in ("regression", "scaler", "metadata.json")):
        return None, "online_model_missing"
    try:
        meta = json.loads(spark.read.text(f"{folder}/metadata.json", wholetext=True).agg(F.max("value")).first()[0])
        model = recall.Model(StandardScalerModel.load(f"{folder}/scaler"), LogisticRegressionModel.load(f"{folder}/regression"), [str(c) for c in meta["feature_columns"]])
    except Exception:  # noqa: BLE001  what is there can't be read as a model, whatever it is
        return None, "online_model_unreadable"
    if meta.get("model_kind") != MODEL_KIND or not model.features or len(model.features) != model.regression.numFeatures:
        return None, "online_model_incompatible"
    return model, "applied"


def reranker(model: recall.Model):
    """What ``Engine.enrich`` takes: adds ml_score and model_kind to candidate rows with features."""

    def rerank(rows: DataFrame) -> DataFrame:
        whole = rows.withColumns({c: F.col(c).cast("double") for c in model.features})
        scored = model.score(whole.withColumn("_row", F.monotonically_increasing_id())).select(*[c for c in rows.columns if c not in model.features], *[F.col(c).cast(rows.schema[c].dataType).alias(c) for c in model.features], "ml_score")
        return scored.withColumn("model_kind", F.lit(MODEL_KIND))

    return rerank


def resolve_dataset(engine: Engine, path: str, names: bool = True, use_split: bool = False, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """A user's table of compound sets and pathway labels: samples (sample_id, member, split, weight, pathway_ids) and, for each row
    that isn't whole, sample_id, reason and detail."""
    rows = readers.tsv(engine.spark, path, ["compounds"], ["sample_id", "pathway_id", "pathway_name", "split", "weight", "source", "note"])
    rows = rows.withColumn("row", F.row_number().over(Window.orderBy("_seq"))).withColumn("sample_id", F.coalesce(T.missing(F.trim("sample_id")), F.concat(F.lit("row_"), F.col("row").cast("string"))))
    multi = lambda c: F.filter(F.transform(F.split(c, ";"), lambda x: F.trim(x)), lambda x: x != "")
    rows = cut(rows.withColumns({"side": F.lower(F.trim("split")), "tokens": multi(F.col("compounds")), "weight": F.coalesce(T.safe_float(F.col("weight")), F.lit(1.0))}))
    bad_split = F.lit(use_split) & ~F.col("side").isin("train", "test")
    tokens = rows.filter(~bad_split).select("row", F.posexplode("tokens").alias("k", "token"))
    known = engine.resolve(tokens.select(F.col("token").alias("query"), F.col("token").alias("qid")).distinct()) if names else _known_ids(engine, tokens)
    hint = F.when(F.size("did_you_mean") > 0, F.concat(F.lit(" | did_you_mean="), F.array_join("did_you_mean", "; "))).otherwise("") if names else F.lit("")
    error = F.when((F.col("status") != "resolved") | (F.col("compound_id") == ""), F.concat(F.coalesce(T.missing(F.col("note")), F.col("status")), hint))
    met = tokens.join(known.withColumnRenamed("query", "token"), "token").withColumn("error", error)
    each = met.groupBy("row").agg(
        F.collect_set(F.when(F.col("error").isNull(), F.col("compound_id"))).alias("members"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("k", F.concat("token", F.lit(": "), "error").alias("t"))))), lambda x: x["t"]).alias("errors"),
    )
    paths = engine.membership.select("pathway_id", "pathway_name").distinct()
    unique = paths.groupBy(T.normalize_name(F.col("pathway_name")).alias("key")).agg(F.min("pathway_id").alias("id"), F.count_distinct("pathway_id").alias("n")).filter("n = 1").select("key", "id")
    by_id = rows.select("row", F.explode(multi(F.col("pathway_id"))).alias("raw")).join(paths.select(F.col("pathway_id").alias("raw"), F.col("pathway_id").alias("id")), "raw", "left").withColumn("w", F.concat(F.lit("unknown pathway_id="), "raw"))
    by_name = rows.select("row", F.explode(multi(F.col("pathway_name"))).alias("raw")).withColumn("key", T.normalize_name(F.col("raw"))).join(unique, "key", "left").withColumn("w", F.concat(F.lit("unmapped pathway_name="), "raw"))
    mapped = by_id.select("row", "id", "w").union(by_name.select("row", "id", "w")).groupBy("row").agg(F.array_sort(F.collect_set("id")).alias("pathway_ids"), F.array_sort(F.collect_set(F.when(F.col("id").isNull(), F.col("w")))).alias("warnings"))
    none = F.array().cast("array<string>")
    rows = cut(rows.join(each, "row", "left").join(mapped, "row", "left").withColumns({c: F.coalesce(c, none) for c in ("members", "errors", "pathway_ids", "warnings")}))
    said, n = F.array_join("errors", " | "), F.size("members")
    small = F.concat(F.lit("Need at least 2 unique resolved compounds, got "), n.cast("string"), F.lit("."), F.when(F.size("errors") > 0, F.concat(F.lit(" Unresolved: "), said)).otherwise(""))
    failed = F.lit(strict) & (F.size("errors") > 0)
    why = lambda reason, detail: F.struct(F.lit(reason).alias("reason"), (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"))
    stop: Column = (
        F.when(bad_split, why("invalid_split", F.concat(F.lit("Unsupported split value: '"), "side", F.lit("'; v1 only supports train/test."))))
        .when(F.size("tokens") == 0, why("empty_compounds", "No compounds listed."))
        .when(failed, why("compound_resolution_failed", said))
        .when(n < 2, why("too_small_set", small))
        .when(F.size("pathway_ids") == 0, why("pathway_unmapped", F.coalesce(T.missing(F.array_join("warnings", " | ")), F.lit("No AraCyc pathway labels mapped."))))
    )
    rows = rows.withColumn("stop", stop)
    partial = rows.filter((F.size("errors") > 0) & ~failed & ~bad_split).select("sample_id", F.lit("compound_resolution_partial").alias("reason"), said.alias("detail"))
    audit = partial.union(rows.filter("stop is not null").select("sample_id", "stop.reason", "stop.detail"))
    good = rows.filter("stop is null").select("sample_id", F.explode("members").alias("member"), F.when(F.lit(use_split), F.col("side")).otherwise("").alias("split"), "weight", "pathway_ids")
    return good, audit


def _known_ids(engine: Engine, tokens: DataFrame) -> DataFrame:
    ids = engine.compounds.select("compound_id", F.explode(F.array("compound_id", "chebi_accession")).alias("key"))
    found = tokens.select(F.col("token").alias("query"), F.upper("token").alias("key")).distinct().join(ids, "key", "left")
    return found.select("query", F.when(F.col("compound_id").isNotNull(), "resolved").otherwise("unmapped").alias("status"), F.coalesce("compound_id", F.lit("")).alias("compound_id"), F.concat(F.lit("unknown ChEBI identifier: "), "query").alias("note"))
