"""Learned recall: pathways of related records for compounds that have none of their own, scored by a logistic regression."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import similarity as sim
from ..functions import text as T
from ..operators import evaluate as E
from ..operators import select as S
from ..sinks import tables as W
from ..sources.paths import Paths
from .build import Standard

#: Thresholds, the seed, and features that a model must not see.
THRESHOLD, HIGH, MEDIUM = 0.55, 0.80, 0.65
POSITIVE_LEAST, NEGATIVES, NEGATIVES_MOST, FEWEST, FOLDS, SEED, FALLBACK = 0.50, 2, 3, 10, 5, 42, 0.50
EXCLUDED = ("arabidopsis_supported", "has_aracyc", "has_ec", "has_formula", "has_hmdb", "has_kegg_xref", "has_lipidmaps", "has_plantcyc", "has_pubchem", "pmn_pathway_count", "rd_available", "stars")
EXCLUDED_PREFIXES = ("origin_", "source_", "status_")
ELEMENTS = ("C", "H", "N", "O", "P", "S", "Cl", "Br")
CANDIDATE_COLUMNS = ["compound_id", "chebi_accession", "chebi_name", "pathway_id", "pathway_name", "pathway_source", "candidate_origin", "bridge_method", "ec_numbers", "reaction_equation"]
PAIR_COLUMNS = ["compound_id", "pathway_name", "label", "label_source", "pathway_source", "candidate_origin"]
PREDICTION_COLUMNS = ["compound_id", "chebi_accession", "chebi_name", "pathway_id", "pathway_name", "pathway_source", "candidate_origin", "ml_score", "ml_confidence", "is_expanded_candidate", "bridge_method", "reason"]


def is_model_feature(name: str) -> bool:
    return name not in EXCLUDED and not name.startswith(EXCLUDED_PREFIXES)


def related_records(s: Standard) -> DataFrame:
    """compound_id, native_id: records of a compound by its accession, its name or an earlier match."""
    names = s.records.select("native_id", F.explode(F.concat(F.array("common_name"), F.col("synonyms"))).alias("n")).select("native_id", T.normalize_name(F.col("n")).alias("key")).filter("key <> ''")
    by_name = s.compounds.select("compound_id", T.normalize_name(F.col("name")).alias("key")).join(names, "key")
    by_id = s.compounds.select("compound_id", F.col("chebi_accession").alias("key")).join(s.records.select("native_id", F.explode("chebi_ids").alias("key")), "key")
    earlier = s.matched_records.join(s.records.select("record_id", "native_id"), "record_id")
    return reduce(DataFrame.unionByName, [f.select("compound_id", "native_id") for f in (by_name, by_id, earlier)]).distinct()


def expanded(s: Standard, ranked: DataFrame, details: DataFrame) -> DataFrame:
    """Pathways of related records for compounds without ranked pathways: one row for each compound, source and pathway."""
    open_ = s.compounds.join(ranked.select("compound_id").distinct(), "compound_id", "left_anti").select("compound_id", "chebi_accession", F.col("name").alias("chebi_name"))
    few = F.array_join(F.slice(F.array_distinct("equations"), 1, 3), " ; ")
    rows = open_.join(related_records(s), "compound_id").join(details.select("native_id", "source_db", "pathway_name", T.ec_numbers(F.array_join("ecs", " ")).alias("ec_numbers"), few.alias("reaction_equation")), "native_id")
    rows = S.best_per_group(rows, ["compound_id", "source_db", "pathway_name"], [F.asc("native_id")])
    return rows.select(
        "compound_id", "chebi_accession", "chebi_name", F.concat_ws(":", "source_db", "native_id", "pathway_name").alias("pathway_id"), "pathway_name", F.col("source_db").alias("pathway_source"),
        F.lit("pmn_direct").alias("candidate_origin"), F.lit("name_or_xref").alias("bridge_method"), "ec_numbers", "reaction_equation",
    )


def compound_features(s: Standard, descriptors: DataFrame | None = None) -> DataFrame:
    """compound_id and its features. descriptors: compound_id and further numeric columns, as a chemistry toolkit gives them."""
    rows = s.compounds.join(s.structures.select("compound_id", "formula", "monoisotopic_mass"), "compound_id", "left").join(s.xrefs, "compound_id", "left")
    plant = s.matched_records.join(s.records.select("record_id", "source_db", F.size("pathways").alias("n")), "record_id").groupBy("compound_id").agg(
        F.max((F.col("source_db") == "AraCyc").cast("double")).alias("has_aracyc"), F.max((F.col("source_db") != "AraCyc").cast("double")).alias("has_plantcyc"), F.sum("n").cast("double").alias("pmn_pathway_count")
    )
    lipid = s.matched_lipids.select("compound_id").distinct().withColumn("has_lipidmaps", F.lit(1.0))
    rows = rows.join(plant, "compound_id", "left").join(lipid, "compound_id", "left").withColumns({"formula": F.coalesce("formula", F.lit("")), "_n": T.element_counts(F.coalesce("formula", F.lit("")))})
    n = lambda e: F.coalesce(F.col("_n")[e], F.lit(0))
    total = lambda keep: F.aggregate(F.filter(F.map_entries("_n"), keep), F.lit(0), lambda a, e: a + e["value"])
    heavy, hetero = total(lambda e: e["key"] != "H"), total(lambda e: ~e["key"].isin("C", "H"))
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    classes = T.semantic_classes(F.col("name"), F.col("definition"))
    out = {
        "mass": F.coalesce(T.safe_float(F.col("monoisotopic_mass")), F.lit(0.0)),
        "has_formula": flag(F.col("formula") != ""),
        **{f"elem_{e}": n(e).cast("double") for e in ELEMENTS},
        "heavy_atom_count_formula": heavy.cast("double"),
        "O_C_ratio": n("O") / F.greatest(n("C"), F.lit(1)),
        "N_C_ratio": n("N") / F.greatest(n("C"), F.lit(1)),
        "heteroatom_ratio": hetero / F.greatest(heavy, F.lit(1)),
        "has_P": flag(n("P") > 0),
        "has_S": flag(n("S") > 0),
        "has_halogen": flag((n("Cl") > 0) | (n("Br") > 0) | (n("F") > 0) | (n("I") > 0)),
        **{f"sem_{c}": flag(F.array_contains(classes, c)) for c in C.SEMANTIC_CLASS_PATTERNS},
        **{f"has_{k}": flag(F.coalesce(F.size(c) > 0, F.lit(False))) for k, c in (("kegg_xref", "kegg_ids"), ("pubchem", "pubchem_cids"), ("hmdb", "hmdb_ids"))},
        **{c: F.coalesce(c, F.lit(0.0)) for c in ("has_lipidmaps", "has_aracyc", "has_plantcyc", "pmn_pathway_count")},
        "arabidopsis_supported": F.coalesce("has_aracyc", F.lit(0.0)),
        "stars": F.col("stars").cast("double"),
        "status_checked": flag(F.col("status_id") == "1"),
        "status_obsolete": flag(F.col("status_id") == "9"),
    }
    found = rows.select("compound_id", *[c.alias(name) for name, c in out.items()])
    return found if descriptors is None else found.join(descriptors, "compound_id", "left").fillna(0.0)


def name_context(s: Standard, most: int = 20) -> DataFrame:
    """compound_id and context: its names and first aliases as one text."""
    w = Window.partitionBy("compound_id").orderBy("stage", "at")
    few = s.aliases.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).groupBy("compound_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "raw_name"))), lambda x: x["raw_name"]), " ").alias("more"))
    return s.compounds.join(few, "compound_id", "left").select("compound_id", F.concat_ws(" ", T.missing(F.col("name")), T.missing(F.col("ascii_name")), "more").alias("context"))


def _overlap(a: Column, b: Column) -> Column:
    x, y = T.tokens(F.coalesce(a, F.lit(""))), T.tokens(F.coalesce(b, F.lit("")))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), sim.jaccard(x, y)).otherwise(0.0)


def pair_features(pairs: DataFrame, features: DataFrame, context: DataFrame, stats: DataFrame, pathway_ecs: DataFrame, reactome_names: DataFrame | None) -> DataFrame:
    """pairs with all features of their compound and of the pair. stats: source_db, name_key, gene_ids, pathway_ids; pathway_ecs:
    source_db, name_key, ecs; reactome_names: pathway_name."""
    rows = pairs.withColumn("name_key", T.normalize_name(F.col("pathway_name")))
    rows = rows.join(features, "compound_id").join(context, "compound_id", "left")
    of = lambda f, **names: f.withColumnsRenamed({"source_db": "pathway_source", **names})
    rows = rows.join(of(pathway_ecs, ecs="_ecs"), ["pathway_source", "name_key"], "left").join(of(stats.select("source_db", "name_key", F.size("gene_ids").alias("_g"), F.size("pathway_ids").alias("_p"))), ["pathway_source", "name_key"], "left")
    if reactome_names is not None:
        words = lambda c: T.tokens(c, letters_only=True)
        a = rows.select("pathway_name").distinct().withColumn("t", F.explode(words(F.col("pathway_name"))))
        b = reactome_names.select(F.col("pathway_name").alias("r")).distinct().withColumn("t", F.explode(words(F.col("r"))))
        like = a.join(b, "t").groupBy("pathway_name", "r").agg(F.count("*").alias("n")).filter("n >= 2").select("pathway_name").distinct().withColumn("has_reactome_match", F.lit(1.0))
        rows = rows.join(like, "pathway_name", "left").fillna(0.0, ["has_reactome_match"])
    else:
        rows = rows.withColumn("has_reactome_match", F.lit(0.0))
    classes = F.array_compact(F.array(*[F.when(F.col(f"sem_{c}") > 0.5, F.lit(c)) for c in C.SEMANTIC_CLASS_PATTERNS]))
    ecs = F.coalesce("_ecs", F.array().cast("array<string>"))
    rows = rows.withColumns(
        {
            "name_pathway_overlap": _overlap(F.col("context"), F.col("pathway_name")),
            "reaction_token_overlap": _overlap(F.col("context"), F.col("reaction_equation")),
            "has_ec": F.when(F.size("ec_numbers") > 0, 1.0).otherwise(0.0),
            "ec_pathway_overlap": F.when((F.size("ec_numbers") > 0) & (F.size(ecs) > 0), sim.jaccard(F.col("ec_numbers"), ecs)).otherwise(0.0),
            "pw_gene_count": F.coalesce(F.col("_g").cast("double"), F.lit(0.0)),
            "pw_pathway_id_count": F.coalesce(F.col("_p").cast("double"), F.lit(0.0)),
            "semantic_consistency": T.semantic_consistency(classes, F.col("pathway_name")),
        }
    )
    return rows.withColumn("compound_class_pathway_match", F.when(F.col("semantic_consistency") > 0, 1.0).otherwise(0.0)).drop("context", "name_key", "_ecs", "_g", "_p")


def training_pairs(ranked: DataFrame, details: DataFrame, seed: int = SEED) -> DataFrame:
    """Positives: ranked pathways of .50 or more, one for each compound and name. Negatives: for each positive two pathways of the
    catalogue, drawn by a hash of the seed, that its compound hasn't; no sequence of draws, so it is the same on any partitioning."""
    key = lambda f: f.withColumn("name_key", T.normalize_name(F.col("pathway_name"))).filter("name_key <> ''")
    good = key(ranked.filter(F.col("score") >= POSITIVE_LEAST).select("compound_id", "pathway_name", F.col("source_db").alias("pathway_source"), "pathway_rank"))
    good = S.best_per_group(good, ["compound_id", "name_key"], [F.asc("pathway_rank")]).drop("pathway_rank")
    none = F.array().cast("array<string>")
    positives = good.withColumns({"label": F.lit(1), "label_source": F.lit("aracyc_primary_score_ge_0.50"), "candidate_origin": F.lit("primary_aracyc"), "ec_numbers": none, "reaction_equation": F.lit("")})
    few = F.array_join(F.slice(F.array_distinct("equations"), 1, 3), " ; ")
    pool = key(details.select("pathway_name", F.col("source_db").alias("pathway_source"), T.ec_numbers(F.array_join("ecs", " ")).alias("ec_numbers"), few.alias("reaction_equation"), "native_id"))
    pool = S.best_per_group(pool, ["pathway_source", "name_key"], [F.asc("native_id"), F.asc("pathway_name")]).drop("native_id")
    # Every pathway has a place on a ring by its hash; a draw takes the next places from its own hash on, with spares for those that
    # the compound has already.
    size = pool.count()
    ring = pool.withColumn("place", F.row_number().over(Window.orderBy(F.xxhash64(F.lit(seed), "pathway_source", "name_key"))) - 1)
    if not size:
        return positives.drop("name_key")
    draws = good.select("compound_id", F.col("name_key").alias("for_key")).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(4 * NEGATIVES - 1))))
    draws = draws.withColumn("place", F.pmod(F.xxhash64(F.lit(seed), "compound_id", "for_key", "k"), F.lit(size)).cast("int"))
    drawn = draws.join(ring, "place").join(good.select("compound_id", "name_key"), ["compound_id", "name_key"], "left_anti")
    once = S.best_per_group(drawn, ["compound_id", "pathway_source", "name_key"], [F.asc("k"), F.asc("for_key")])
    kept = once.withColumn("_n", F.row_number().over(Window.partitionBy("compound_id", "for_key").orderBy("k"))).filter(F.col("_n") <= NEGATIVES)
    negatives = kept.select("compound_id", "pathway_name", "pathway_source", "name_key", F.lit(0).alias("label"), F.lit("hard_negative").alias("label_source"), F.lit("pmn_direct").alias("candidate_origin"), "ec_numbers", "reaction_equation")
    return positives.unionByName(negatives).drop("name_key")


@dataclass
class Model:
    scaler: StandardScalerModel
    regression: LogisticRegressionModel
    features: list[str]

    def score(self, rows: DataFrame, name: str = "ml_score") -> DataFrame:
        made = self.regression.transform(self.scaler.transform(_vectors(rows, self.features)))
        return made.withColumn(name, vector_to_array("probability")[1]).drop("_raw", "_scaled", "probability", "rawPrediction", "prediction")


def _vectors(rows: DataFrame, features: list[str]) -> DataFrame:
    finite = lambda c: F.when(F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(F.col(c).cast("double"))
    return VectorAssembler(inputCols=features, outputCol="_raw").transform(rows.withColumns({c: finite(c) for c in features}))


def fit(rows: DataFrame, features: list[str]) -> Model:
    """Standardised features, classes of equal weight, and a penalty of 1 against the sum of losses."""
    n = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    weight = F.when(F.col("label") == 1, total / (2.0 * n.get(1, 1))).otherwise(total / (2.0 * n.get(0, 1)))
    vectors = _vectors(rows, features).withColumn("_w", weight)
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(vectors)
    plain = LogisticRegression(featuresCol="_scaled", labelCol="label", weightCol="_w", maxIter=1000, regParam=1.0 / total, elasticNetParam=0.0, standardization=False)
    return Model(scaler, plain.fit(scaler.transform(vectors)), features)


def train(rows: DataFrame, features: list[str]) -> tuple[Model, dict[str, object]]:
    """The model of all rows, and what its cross-validation by compound and its training rows say of it."""
    rows = rows.persist()
    auc = BinaryClassificationEvaluator(rawPredictionCol="ml_score", labelCol="label", metricName="areaUnderROC")
    groups = rows.select("compound_id").distinct().count()
    folds = min(FOLDS, groups)
    scores = []
    if folds >= 2:
        split = E.folds(rows, "compound_id", folds, SEED)
        for k in range(folds):
            part, held = split.filter(F.col("fold") != k), split.filter(F.col("fold") == k)
            if min(part.select("label").distinct().count(), held.select("label").distinct().count()) == 2:
                scores.append(auc.evaluate(fit(part, features).score(held)))
    model = fit(rows, features)
    made = model.score(rows).withColumn("hit", (F.col("ml_score") >= 0.5).cast("int")).persist()
    c = made.agg(*[F.count_if((F.col("label") == a) & (F.col("hit") == b)).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)]).first()
    mean = sum(scores) / len(scores) if scores else 0.0
    weights = sorted(zip(model.regression.coefficients.toArray().tolist(), features, strict=True))
    meta = {
        "model_type": "LogisticRegression", "feature_count": len(features), "training_samples": c.n00 + c.n01 + c.n10 + c.n11, "positive_samples": c.n10 + c.n11, "negative_samples": c.n00 + c.n01,
        "cv_strategy": "GroupHash" if scores else "skipped", "cv_group_count": groups, "cv_roc_auc_mean": round(mean, 4), "cv_roc_auc_std": round((sum((x - mean) ** 2 for x in scores) / len(scores)) ** 0.5, 4) if scores else 0.0,
        "train_roc_auc": round(auc.evaluate(made), 4), "train_precision": round(c.n11 / max(c.n11 + c.n01, 1), 4), "train_recall": round(c.n11 / max(c.n11 + c.n10, 1), 4), "ml_score_threshold": THRESHOLD,
        "top_positive_features": [(n, round(v, 4)) for v, n in weights[::-1][:10]], "top_negative_features": [(n, round(v, 4)) for v, n in weights[:10]], "random_seed": SEED,
    }
    made.unpersist()
    rows.unpersist()
    return model, meta


def predictions(scored: DataFrame) -> DataFrame:
    """Candidates of the threshold or more, with their confidence and reason."""
    level = F.when(F.col("ml_score") >= HIGH, "high").when(F.col("ml_score") >= MEDIUM, "medium").otherwise("low")
    why = [F.concat(F.lit("expanded recall via "), "candidate_origin"), F.concat(F.lit("source="), "pathway_source"), F.concat(F.lit("ml_score="), F.format_string("%.3f", "ml_score")), F.when(F.col("bridge_method") != "", F.concat(F.lit("bridge="), "bridge_method"))]
    return scored.filter(F.col("ml_score") >= THRESHOLD).withColumns({"ml_confidence": level, "is_expanded_candidate": F.lit(True), "reason": F.concat_ws("; ", *why)})


def run(paths: Paths, s: Standard, ranked: DataFrame, details: DataFrame, stats: DataFrame, pathway_ecs: DataFrame, reactome_names: DataFrame | None = None, descriptors: DataFrame | None = None) -> dict[str, object]:
    """Candidates, training pairs, model and predictions of a built work folder, written beside its indexes; gives the metadata."""
    spark = ranked.sparkSession
    by_id = [F.expr("try_cast(compound_id as bigint)"), F.asc("compound_id"), F.asc("pathway_id")]
    found = expanded(s, ranked, details)
    W.write_tsv(found, paths.index("expanded_candidates.tsv"), CANDIDATE_COLUMNS, by_id)
    if found.isEmpty():
        meta: dict[str, object] = {"status": "skipped", "reason": "no expanded candidates"}
        scored = found.withColumn("ml_score", F.lit(0.0))
    else:
        pairs = training_pairs(ranked, details)
        W.write_tsv(pairs, paths.index("ml_training_pairs.tsv"), PAIR_COLUMNS, [F.desc("label"), *by_id[:2], F.asc("pathway_name")])
        if pairs.filter("label = 1").count() < FEWEST:
            meta, scored = {"status": "fallback", "reason": "insufficient training data"}, found.withColumn("ml_score", F.lit(FALLBACK))
        else:
            own, context = compound_features(s, descriptors), name_context(s)
            rows = pair_features(pairs, own, context, stats, pathway_ecs, reactome_names)
            plain = {*pairs.columns}
            names = sorted(c for c, kind in rows.dtypes if kind == "double" and c not in plain)
            model, meta = train(rows, [c for c in names if is_model_feature(c)])
            meta |= {"raw_feature_count": len(names), "excluded_model_features": [c for c in names if not is_model_feature(c)], "leakage_features_in_model": [c for c in names if is_model_feature(c) and c.startswith(("source_", "origin_"))]}
            scored = model.score(pair_features(found, own, context, stats, pathway_ecs, reactome_names))
            at = E.percentiles(scored, "ml_score", [0.5, 0.9, 0.95, 0.99]).first().asDict()
            ends = scored.agg(F.min("ml_score").alias("min"), F.max("ml_score").alias("max"), F.avg("ml_score").alias("mean")).first().asDict()
            meta["score_distribution"] = {k: round(v, 4) for k, v in (at | ends).items()}
            model.regression.write().overwrite().save(paths.index("ml_model/regression"))
            model.scaler.write().overwrite().save(paths.index("ml_model/scaler"))
    W.write_tsv(predictions(scored), paths.index("ml_pathway_predictions.tsv"), PREDICTION_COLUMNS, by_id, {"ml_score": ".4f"})
    W.write_json(spark, meta, paths.index("ml_model_metadata.json"))
    return meta
