"""Questions to a built work folder: names, keys and structures to compounds and pathways, and sets of names to enriched pathways.

Every question is a DataFrame of queries (qid, query) and every answer one DataFrame with a row for each: the cascade is a union of
routes and a window, so a thousand queries cost one plan. Chemistry from structures is supplied, not computed: a SMILES query is looked
up among known structures for its key and fingerprint.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from .. import constants as C
from ..functions import similarity as sim
from ..functions import stats
from ..functions import text as T
from ..functions.numbers import exact_round
from ..operators import resolve as R
from ..operators import select as S
from ..operators import structure as ST
from ..operators.lineage import cut
from ..sinks import tables as W
from ..sources import catalog as K
from ..sources import readers
from ..sources.paths import Paths, exists

FULL_KEY, BLOCK, SMILES = r"^[A-Z]{14}-[A-Z]{10}-[A-Z]$", r"^block:([A-Z]{14})$", r"(?is)^smiles:(.+)$"
OTHER_LENGTH = 0.40
NOTES = {
    "empty": "Input query is empty.",
    "key": "No Arabidopsis compound has this exact InChIKey.",
    "block": "No Arabidopsis compound shares this InChIKey connectivity block.",
    "smiles": "Input is not a valid SMILES string in the current environment.",
    "far": f"No Arabidopsis structural neighbors met the Tanimoto >= {C.SMILES_LEAST:.2f} threshold.",
    "none": "No AraCyc/PlantCyc mapping found.",
    "suggested": "No exact Arabidopsis or strict ChEBI recovery succeeded.",
    "outside": "Resolved compound is not present in the AraCyc pathway membership universe.",
}
MAPPING = ["compound_id", "chebi_accession", "chebi_name", "aracyc_compound_id", "aracyc_common_name", "source_db", "match_method", "match_score", "chebi_xref_direct", "structure_validated", "pathway_count", "pathways"]
PATHWAY = [
    "compound_id", "chebi_name", "pathway_name", "pathway_id", "pathway_category", "score", "confidence_level", "match_method", "aracyc_compound_id", "source_db", "gene_count", "ec_numbers", "annotation_confidence",
    "reason", "support_similarity", "recovered_chebi_id", "kegg_support_present", "kegg_ath_pathway_id", "kegg_ath_pathway_name", "kegg_alignment_score", "kegg_alignment_confidence",
]


def _letters(c: Column) -> Column:
    """How often each letter and digit occurs, with blanks: what two names can have in common at most."""
    return F.array(*[F.length(c) - F.length(F.replace(c, F.lit(x), F.lit(""))) for x in " 0123456789abcdefghijklmnopqrstuvwxyz"])


def fuzzy_scores(queries: DataFrame, names: DataFrame, least: float = C.FUZZY_LEAST) -> DataFrame:
    """qid, name, ratio: names whose best ratio to a variant of the query's name is at least ``least``, of near length to its exact
    form. queries: qid and variants (a struct); names: distinct normalised names.

    The ratio is 2 M / (a + b) for M matching characters, so lengths and common letters bound it: names join by length, and the
    few that the bounds leave are compared in Arrow batches.
    """
    forms = queries.select("qid", F.col("variants.exact").alias("exact"), F.explode(F.array_distinct(F.array(*[F.col(f"variants.{v}") for v in T.VARIANTS]))).alias("form")).filter("form <> ''")
    share = least / (2 - least)
    sizes = F.sequence(F.ceil(F.length("form") * share - 1e-9).cast("int"), F.floor(F.length("form") / share + 1e-9).cast("int"))
    left = forms.withColumns({"size": F.explode(sizes), "own": _letters(F.col("form"))})
    right = names.select(F.col("name"), F.length("name").alias("size"), _letters(F.col("name")).alias("theirs"))
    near = left.join(right, "size").filter(sim.lengths_near(F.col("exact"), F.col("name"), OTHER_LENGTH))
    common = F.aggregate(F.zip_with("own", "theirs", lambda a, b: F.least(a, b)), F.lit(0), lambda s, x: s + x)
    bound = near.filter(2 * common >= least * (F.length("form") + F.length("name")) - 1e-9)
    scored = bound.select("qid", "name", sim.sequence_ratio(F.col("form"), F.col("name")).alias("ratio"))
    return scored.groupBy("qid", "name").agg(F.max("ratio").alias("ratio")).filter(F.col("ratio") >= least)


def _by_score(order: list[Column]) -> Column:
    return F.row_number().over(Window.partitionBy("qid").orderBy(*order))


@dataclass
class Engine:
    """The tables of a built work folder, ready to be asked."""

    spark: SparkSession
    mappings: DataFrame
    pathways: DataFrame
    membership: DataFrame
    names: DataFrame
    compounds: DataFrame
    structures: DataFrame
    support: DataFrame
    expanded: DataFrame
    parents: DataFrame
    paths: Paths | None = None

    @classmethod
    def load(cls, spark: SparkSession, paths: Paths, fingerprints: DataFrame | None = None) -> Engine:
        """Reads the written tables; those of later steps (alignment, predictions) may be missing. fingerprints: compound_id, fp."""
        flag = lambda c: (F.col(c) == "true").alias(c)
        number = lambda c, kind: F.coalesce(T.missing(F.col(c)).try_cast(kind), F.lit(0).cast(kind)).alias(c)
        mapped = readers.tsv(spark, paths.index("name_to_aracyc_index.tsv"), MAPPING)
        mapped = mapped.select(*MAPPING[:7], number("match_score", "double"), flag("chebi_xref_direct"), flag("structure_validated"), number("pathway_count", "int"), "pathways", "_seq")
        columns = ["compound_id", "chebi_name", "pathway_rank", "score", "confidence_level", "match_method", "aracyc_compound_id", "source_db", "pathway_id", "pathway_name", "pathway_category", "gene_count", "ec_numbers", "annotation_confidence", "reason"]
        ranked = readers.tsv(spark, f"{paths.tables}/chebi_pathways_aracyc_refactored.tsv", columns)
        ranked = ranked.withColumns({"score": number("score", "double"), "pathway_rank": number("pathway_rank", "int"), "gene_count": number("gene_count", "int")})
        member = readers.tsv(spark, paths.index("aracyc_compound_pathway_index.tsv"), ["compound_id", "source_db", "pathway_id", "pathway_name"])
        compounds = K.compounds(spark, f"{paths.workdir}/compounds.tsv")
        structures = K.structures(spark, paths.ref("structures.tsv.gz"), K.formulas(spark, paths.ref("chemical_data.tsv.gz")), by_status=True)
        structures = structures.join(fingerprints, "compound_id", "left") if fingerprints is not None else structures.withColumn("fp", F.lit(None).cast("array<long>"))
        best, predicted = paths.index("kegg_ath_to_aracyc_pathway_best.tsv"), paths.index("ml_pathway_predictions.tsv")
        aligned = ["aracyc_pathway_id", "ath_pathway_id", "ath_pathway_name", "alignment_score", "alignment_confidence"]
        support = readers.tsv(spark, best, aligned) if exists(spark, best) else spark.createDataFrame([], ", ".join(f"{c} string" for c in [*aligned, "_seq"]))
        guessed = ["compound_id", "chebi_name", "pathway_name", "pathway_source", "ml_score", "ml_confidence", "reason"]
        expanded = readers.tsv(spark, predicted, guessed) if exists(spark, predicted) else spark.createDataFrame([], ", ".join(f"{c} string" for c in [*guessed, "_seq"]))
        return cls(
            spark, mapped, ranked, membership(member), strict_names(compounds, K.chebi_names(spark, paths.ref("names.tsv.gz"))), compounds, structures, best_support(support),
            expanded.withColumn("ml_score", number("ml_score", "double")), K.parents(spark, f"{paths.workdir}/compounds.tsv"), paths,
        )

    # --- parts of the cascade ---------------------------------------------------------------------------------------------

    def name_index(self) -> DataFrame:
        """key and mapping row: every variant of a mapping's two names."""
        both = self.mappings.select("_seq", F.explode(F.array("chebi_name", "aracyc_common_name")).alias("n")).withColumn("v", T.variants(F.col("n")))
        keys = both.select("_seq", F.explode(F.array(*[F.col(f"v.{v}") for v in T.VARIANTS])).alias("key")).filter("key <> ''").distinct()
        return keys.join(self.mappings, "_seq")

    def structure_index(self) -> DataFrame:
        """Structures of compounds that have pathways."""
        rows = self.structures.join(self.pathways.select("compound_id").distinct(), "compound_id", "left_semi")
        rows = rows.filter("standard_inchi_key <> '' or smiles <> ''")
        return rows.withColumns({"key": F.upper("standard_inchi_key"), "block": T.inchi_block(F.col("standard_inchi_key"))})

    def route(self, queries: DataFrame) -> DataFrame:
        """queries with the trimmed text, the route it takes and, for plain text, the variants of the name."""
        text = F.trim(F.coalesce("query", F.lit("")))
        kind = F.when(text == "", "empty").when(text.rlike(FULL_KEY), "key").when(text.rlike(BLOCK), "block").when(text.rlike(SMILES), "smiles").otherwise("plain")
        return queries.select("qid", "query", text.alias("text"), kind.alias("route")).withColumn("variants", T.variants(F.when(F.col("route") == "plain", F.col("text"))))

    def direct(self, plain: DataFrame, index: DataFrame) -> DataFrame:
        """qid, mapping row and place: the mappings of any variant of the name, one for each compound, best first, five at most."""
        forms = F.array(*[F.struct(F.lit(i).alias("variant_rank"), F.col(f"variants.{v}").alias("key")) for i, v in enumerate(T.VARIANTS)])
        asked = plain.select("qid", F.explode(forms).alias("f")).select("qid", "f.*").filter("key <> ''")
        hits = S.best_per_group(asked.join(index, "key"), ["qid", "compound_id"], [F.asc("variant_rank"), F.asc("_seq")])
        return hits.withColumn("place", _by_score([F.desc("match_score"), F.asc("variant_rank"), F.asc("_seq")])).filter("place <= 5")

    def fuzzy(self, plain: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Mappings as in ``direct`` of names that are near enough and ahead of the next, and qid with did_you_mean."""
        long = plain.filter(F.length("text") >= C.FUZZY_SHORTEST)
        scores = fuzzy_scores(long, index.select(F.col("key").alias("name")).distinct())
        w = Window.partitionBy("qid").orderBy(F.desc("ratio"), F.asc("name"))
        top = scores.withColumns({"n": F.row_number().over(w), "gap": F.col("ratio") - F.coalesce(F.lead("ratio").over(w), F.lit(0.0))}).filter(F.col("n") <= C.FUZZY_SUGGESTIONS)
        shown = top.join(index.withColumnRenamed("key", "name"), "name").withColumn("label", T.display_name(F.col("chebi_name"), F.col("aracyc_common_name")))
        first = S.best_per_group(shown, ["qid", "label"], [F.asc("n"), F.asc("_seq")])
        listed = first.withColumn("k", F.row_number().over(Window.partitionBy("qid").orderBy("n", "_seq"))).filter(F.col("k") <= C.FUZZY_SUGGESTIONS)
        suggestions = listed.groupBy("qid").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "label"))), lambda x: x["label"]).alias("did_you_mean"))
        sure = top.filter((F.col("n") == 1) & (F.col("ratio") >= C.FUZZY_AUTO) & (F.col("gap") >= C.FUZZY_GAP - 1e-12))
        hits = S.best_per_group(sure.select("qid", "name").join(index.withColumnRenamed("key", "name"), "name"), ["qid", "compound_id"], [F.desc("match_score"), F.asc("_seq")])
        return hits.withColumn("place", _by_score([F.desc("match_score"), F.asc("_seq")])).filter("place <= 5"), suggestions

    def recovered(self, plain: DataFrame) -> DataFrame:
        """qid and the compounds that its name stands for strictly (exact, else without blanks), ranked: by whether it is their main
        name, its likeness, stars and id."""
        forms = F.array(*[F.struct(F.lit(i).alias("variant_rank"), F.lit(v).alias("variant"), F.col(f"variants.{v}").alias("key")) for i, v in enumerate(C.STRICT_VARIANTS)])
        asked = plain.select("qid", "variants", F.explode(forms).alias("f")).select("qid", "variants", "f.*").filter("key <> ''")
        hits = asked.join(self.names, ["variant", "key"])
        first = F.min("variant_rank").over(Window.partitionBy("qid"))
        hits = hits.withColumn("_first", first).filter("variant_rank = _first").select("qid", "variants", "compound_id").distinct().join(self.compounds, "compound_id")
        main = T.variants(F.trim(F.coalesce(T.missing(F.col("ascii_name")), F.col("name"))))
        hits = hits.withColumn("main", main)
        same = reduce(lambda a, b: a | b, [(F.col(f"main.{v}") != "") & (F.col(f"main.{v}") == F.col(f"variants.{v}")) for v in C.STRICT_VARIANTS])
        both = (F.col("main.exact") != "") & (F.col("variants.exact") != "")
        likeness = F.when(both, sim.sequence_ratio(F.when(both, F.col("main.exact")), F.when(both, F.col("variants.exact")))).otherwise(0.0)
        hits = hits.withColumns({"main_match": same, "main_similarity": likeness, "number": F.col("compound_id").try_cast("bigint")})
        order = [F.desc("main_match"), F.desc("main_similarity"), F.desc("stars"), F.asc("number")]
        return hits.withColumns({"candidate_rank": _by_score(order), "n_candidates": F.count("*").over(Window.partitionBy("qid"))})

    def project(self, candidates: DataFrame, index: DataFrame) -> DataFrame:
        """qid, candidate, how, compound_id, similarity, place: compounds with pathways that a recovered compound leads to: itself, else
        those of the same key, else those of its block and formula or near it by fingerprint, formula, charge and mass."""
        of = candidates.select("qid", F.col("compound_id").alias("candidate"))
        itself = of.join(self.mappings.select("compound_id").distinct(), F.col("candidate") == F.col("compound_id"), "left_semi").select("qid", "candidate", F.lit(0).alias("tier"), F.col("candidate").alias("compound_id"), F.lit(1.0).alias("similarity"))
        own = of.join(self.structures.select(F.col("compound_id").alias("candidate"), F.upper("standard_inchi_key").alias("key"), T.inchi_block(F.col("standard_inchi_key")).alias("block"), "formula_key", "charge", "exact_mass", "fp"), "candidate")
        there = index.select("compound_id", "key", "block", F.col("formula_key").alias("f2"), F.col("charge").alias("c2"), F.col("exact_mass").alias("m2"), F.col("fp").alias("fp2"))
        same = own.filter("key <> ''").join(there.select("compound_id", "key"), "key").select("qid", "candidate", F.lit(1).alias("tier"), "compound_id", F.lit(1.0).alias("similarity"))
        block = own.filter("block <> '' and formula_key <> ''").join(there, "block").filter("f2 = formula_key").select("qid", "candidate", F.lit(2).alias("tier"), "compound_id", F.lit(C.BLOCK_SIMILARITY).alias("similarity"))
        fits = sim.masses_fit(F.col("exact_mass"), F.col("m2")) & sim.charges_fit(T.missing(F.col("charge")), T.missing(F.col("c2")))
        near = own.filter("formula_key <> '' and fp is not null").join(there.filter("fp2 is not null"), F.col("formula_key") == F.col("f2")).filter(fits)
        near = near.withColumn("similarity", sim.tanimoto(F.col("fp"), F.col("fp2"))).filter(F.col("similarity") >= C.RECOVERED_LEAST).select("qid", "candidate", F.lit(2).alias("tier"), "compound_id", "similarity")
        rows = reduce(DataFrame.unionByName, [itself, same, block, near])
        tier = F.min("tier").over(Window.partitionBy("qid", "candidate"))
        rows = rows.withColumn("_t", tier).filter("tier = _t").groupBy("qid", "candidate", "tier", "compound_id").agg(F.max("similarity").alias("similarity"))
        w = Window.partitionBy("qid", "candidate").orderBy(F.desc("similarity"), F.expr("try_cast(compound_id as bigint)"))
        return rows.withColumn("place", F.row_number().over(w)).filter((F.col("tier") < 2) | (F.col("place") <= C.MOST_NEIGHBORS))

    def structure_queries(self, routed: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Neighbours of key, block and SMILES queries, and what each such query is if it has none."""
        keyed = routed.filter("route = 'key'").select("qid", F.upper("text").alias("key"))
        by_key = keyed.join(index.select("key", "compound_id"), "key").select("qid", F.lit("exact_structure").alias("match_type"), F.lit("inchikey -> exact_structure").alias("path"), "compound_id", F.lit(1.0).alias("similarity"))
        blocks = routed.filter("route = 'block'").select("qid", F.regexp_extract("text", BLOCK, 1).alias("block"))
        by_block = blocks.join(index.select("block", "compound_id"), "block").select("qid", F.lit("structural_neighbor").alias("match_type"), F.lit("block -> structural_neighbor").alias("path"), "compound_id", F.lit(C.BLOCK_SIMILARITY).alias("similarity"))
        known = S.best_per_group(self.structures.filter("smiles <> ''"), ["smiles"], [F.asc("compound_id")]).select("smiles", F.upper("standard_inchi_key").alias("key"), "fp")
        smiles = routed.filter("route = 'smiles'").select("qid", F.trim(F.regexp_extract("text", SMILES, 1)).alias("smiles")).join(known, "smiles", "left")
        exact = smiles.filter("key <> ''").join(index.select("key", "compound_id"), "key").select("qid", F.lit("exact_structure").alias("match_type"), F.lit("smiles -> exact_structure").alias("path"), "compound_id", F.lit(1.0).alias("similarity"))
        open_ = smiles.join(exact.select("qid"), "qid", "left_anti").filter("fp is not null").select(F.concat(F.lit("?"), F.col("qid").cast("string")).alias("id"), "fp")
        near = ST.nearest(open_, index.select(F.col("compound_id").alias("id"), "fp"), "id", "fp", C.MOST_NEIGHBORS, C.SMILES_LEAST)
        kind = routed.schema["qid"].dataType
        by_shape = near.select(F.expr("substring(query_id, 2)").cast(kind).alias("qid"), F.lit("structural_neighbor").alias("match_type"), F.lit("smiles -> structural_neighbor").alias("path"), F.col("record_id").alias("compound_id"), "similarity")
        rows = reduce(DataFrame.unionByName, [by_key, by_block, exact, by_shape])
        rows = rows.withColumn("place", _by_score([F.desc("similarity"), F.expr("try_cast(compound_id as bigint)")]))
        seen = F.when(F.col("fp").isNotNull(), F.lit("far")).otherwise(F.lit("smiles"))
        failed = (
            routed.filter("route in ('key', 'block')").select("qid", "route", F.when(F.col("route") == "key", "inchikey -> exact_structure").otherwise("block -> structural_neighbor").alias("path"), F.col("route").alias("why"))
            .unionByName(smiles.select("qid", F.lit("smiles").alias("route"), F.when(F.col("fp").isNotNull(), "smiles -> structural_neighbor").otherwise("smiles").alias("path"), seen.alias("why")))
        )
        return rows, failed.join(rows.select("qid").distinct(), "qid", "left_anti")

    def best_pathways(self, neighbors: DataFrame, top_k: int) -> DataFrame:
        """The pathways of each query's neighbours: score times similarity, the best of each pathway, top_k of them."""
        rows = neighbors.select("qid", "compound_id", "similarity", "place", "recovered_chebi_id").join(self.pathways, "compound_id")
        near = F.concat("reason", F.lit("; structural_similarity="), F.format_string("%.3f", exact_round(F.col("similarity"), 3)))
        rows = rows.withColumns({"score": exact_round(F.col("score") * F.col("similarity")), "_key": F.coalesce(T.missing(F.col("pathway_id")), F.col("pathway_name")), "reason": F.when(F.col("similarity") >= 0.999, F.col("reason")).otherwise(near)})
        best = S.best_per_group(rows, ["qid", "_key"], [F.desc("score"), F.asc("place"), F.asc("pathway_rank")])
        kept = best.withColumn("rank", _by_score([F.desc("score"), F.desc("similarity"), F.asc("place"), F.asc("pathway_rank"), F.asc("_key")])).filter(F.col("rank") <= top_k)
        return with_support(kept, self.support).withColumnRenamed("similarity", "support_similarity")

    # --- answers ----------------------------------------------------------------------------------------------------------

    def query(self, queries: DataFrame, top_k: int = 10, no_fuzzy: bool = False) -> DataFrame:
        """One row for each query (qid, query): match_type, resolution_path, projection_type, mappings, pathways, expanded,
        matched_compound, neighbor_similarity, did_you_mean, recovered_chebi_id and note."""
        routed, index, shapes = self.route(queries), self.name_index(), self.structure_index()
        plain = routed.filter("route = 'plain'")
        # What several parts of the answer start from is cut, so that each is computed once.
        direct = cut(self.direct(plain, index).select("qid", "compound_id", "place"))
        rest = plain.join(direct.select("qid").distinct(), "qid", "left_anti")
        text_type = Y.ArrayType(Y.StringType())
        if no_fuzzy:
            fuzzy, suggestions = direct.limit(0), self.spark.createDataFrame([], Y.StructType([routed.schema["qid"], Y.StructField("did_you_mean", text_type)]))
        else:
            fuzzy, suggestions = self.fuzzy(rest, index)
            fuzzy, suggestions = cut(fuzzy.select("qid", "compound_id", "place")), cut(suggestions)
        rest = rest.join(fuzzy.select("qid").distinct(), "qid", "left_anti")
        candidates = cut(self.recovered(rest))
        projected = cut(self.project(candidates, shapes))
        # The first tier of a projection says how it was reached and what its mapping is worth.
        worth = self.mappings.groupBy("compound_id").agg(F.max("match_score").alias("own_score"))
        attempts = projected.groupBy("qid", F.col("candidate").alias("compound_id")).agg(F.first("tier").alias("tier"), F.max("similarity").alias("likest")).join(candidates, ["qid", "compound_id"]).join(worth, "compound_id", "left")
        exact_worth = projected.filter("tier = 1").join(worth, "compound_id").groupBy("qid", F.col("candidate").alias("compound_id")).agg(F.max("own_score").alias("key_score"))
        attempts = attempts.join(exact_worth, ["qid", "compound_id"], "left")
        value = F.when(F.col("tier") == 0, F.col("own_score")).when(F.col("tier") == 1, F.coalesce("key_score", F.lit(0.0))).otherwise(F.col("likest"))
        chosen = S.best_per_group(attempts.withColumn("worth", value), ["qid"], [F.desc("main_match"), F.desc("main_similarity"), F.desc("worth"), F.desc("stars"), F.asc("number")])
        by_shape, failed = self.structure_queries(routed, shapes)
        one = lambda rows, kind, path: rows.select("qid", F.lit(kind).alias("match_type"), F.lit(path).alias("path"), "compound_id", F.lit(1.0).alias("similarity"), "place", F.lit("").alias("recovered_chebi_id"), F.lit("").alias("projection_type"))
        how = F.element_at(F.array(*map(F.lit, ("plain_text -> chebi_exact -> aracyc_mapping", "plain_text -> chebi_exact -> exact_structure", "plain_text -> chebi_exact -> structural_neighbor"))), F.col("tier") + 1)
        projection = F.element_at(F.array(*map(F.lit, ("", "exact_structure", "structural_neighbor"))), F.col("tier") + 1)
        found = projected.join(chosen.select("qid", F.col("compound_id").alias("candidate"), "chebi_accession"), ["qid", "candidate"])
        by_recovery = found.select("qid", F.lit("recovered_from_chebi").alias("match_type"), how.alias("path"), "compound_id", "similarity", "place", F.col("chebi_accession").alias("recovered_chebi_id"), projection.alias("projection_type"))
        shaped = by_shape.withColumns({"recovered_chebi_id": F.lit(""), "projection_type": F.lit("")}).select(by_recovery.columns)
        neighbors = reduce(DataFrame.unionByName, [one(direct, "direct", "plain_text -> arabidopsis_direct"), one(fuzzy, "fuzzy", "plain_text -> arabidopsis_fuzzy"), by_recovery, shaped])
        neighbors = cut(neighbors)
        pathways = cut(self.best_pathways(neighbors, top_k))
        outcome = neighbors.groupBy("qid").agg(*[F.first(c).alias(c) for c in ("match_type", "path", "projection_type")])
        # A recovered compound without pathways still has its mappings.
        base = direct.unionByName(fuzzy).select("qid", "compound_id").unionByName(neighbors.filter("match_type = 'recovered_from_chebi'").filter("projection_type = ''").select("qid", "compound_id"))
        of_pathways = pathways.join(base.select("qid").distinct(), "qid", "left_anti").select("qid", "compound_id")
        mapped = S.best_per_group(base.unionByName(of_pathways).distinct().join(self.mappings, "compound_id"), ["qid", "compound_id"], [F.desc("match_score"), F.asc("_seq")])
        mapped = mapped.withColumn("n", _by_score([F.desc("match_score"), F.asc("_seq")]))
        ordered = lambda key, columns: F.transform(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.struct(*columns).alias("x")))), lambda s: s["x"])
        maps = mapped.groupBy("qid").agg(ordered("n", MAPPING).alias("mappings"))
        best = pathways.groupBy("qid").agg(ordered("rank", PATHWAY).alias("pathways"), F.max("support_similarity").alias("neighbor_similarity"))
        guesses = direct.unionByName(fuzzy).select("qid", "compound_id").distinct().join(self.expanded, "compound_id")
        guesses = guesses.withColumn("n", _by_score([F.desc("ml_score"), F.asc("_seq")])).filter(F.col("n") <= top_k).groupBy("qid").agg(ordered("n", ["compound_id", "chebi_name", "pathway_name", "pathway_source", "ml_score", "ml_confidence", "reason"]).alias("expanded"))
        few = candidates.filter(F.col("candidate_rank") <= C.FUZZY_SUGGESTIONS).withColumn("label", F.concat("name", F.lit(" ("), "chebi_accession", F.lit(")")))
        by_stars = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("stars"), "number"))
        first_seen = candidates.withColumn("_n", by_stars).filter("_n = 1").select("qid", F.col("chebi_accession").alias("first_seen"))
        listed = few.groupBy("qid").agg(F.transform(F.array_sort(F.collect_list(F.struct("candidate_rank", "label"))), lambda x: x["label"]).alias("candidates"), F.first("n_candidates").alias("n_candidates")).join(first_seen, "qid")
        rows = routed.select("qid", "query", "text", "route")
        for more in (outcome, maps, best, guesses, suggestions, listed, chosen.select("qid", F.col("chebi_accession").alias("chosen")), failed.select("qid", F.col("path").alias("failed_path"), "why")):
            rows = rows.join(more, "qid", "left")
        several = F.concat(F.lit("Recovered "), F.col("n_candidates").cast("string"), F.lit(" strict ChEBI candidates"))
        note = (
            F.when(F.col("route") == "empty", NOTES["empty"])
            .when(F.col("chosen").isNotNull() & (F.col("n_candidates") > 1), F.concat(several, F.lit("; selected "), "chosen", F.lit(" after ranking by primary-name priority and Arabidopsis mapping support.")))
            .when(F.col("match_type").isNotNull(), "")
            .when(F.col("n_candidates").isNotNull(), F.concat(several, F.lit(" and ranked them by primary-name priority, but none could be mapped back to Arabidopsis via direct mapping or high-confidence structure projection.")))
            .when(F.col("why").isNotNull(), F.element_at(F.create_map(*[x for k in ("key", "block", "smiles", "far") for x in (F.lit(k), F.lit(NOTES[k]))]), F.col("why")))
            .when(F.size("did_you_mean") > 0, NOTES["suggested"])
            .otherwise(NOTES["none"])
        )
        path = F.coalesce("path", F.when(F.col("route") == "empty", "empty"), F.when(F.col("n_candidates").isNotNull(), "plain_text -> chebi_exact"), "failed_path", F.lit("plain_text"))
        listed_ones = F.when(F.col("n_candidates").isNotNull() & ((F.col("n_candidates") > 1) | F.col("chosen").isNull()), F.col("candidates"))
        none = F.array().cast(text_type)
        recovered_id = F.coalesce(F.get("pathways", F.lit(0))["recovered_chebi_id"], F.col("chosen"), F.when(F.col("match_type").isNull(), F.col("first_seen")), F.lit(""))
        return rows.select(
            "qid", "query", F.coalesce("match_type", F.lit("")).alias("match_type"), path.alias("resolution_path"), F.coalesce("projection_type", F.lit("")).alias("projection_type"),
            F.coalesce("mappings", F.array().cast(rows.schema["mappings"].dataType)).alias("mappings"), F.coalesce("pathways", F.array().cast(rows.schema["pathways"].dataType)).alias("pathways"),
            F.coalesce("expanded", F.array().cast(rows.schema["expanded"].dataType)).alias("expanded"),
            F.coalesce(F.get("pathways", F.lit(0))["chebi_name"], F.get("mappings", F.lit(0))["chebi_name"], F.lit("")).alias("matched_compound"),
            F.coalesce("neighbor_similarity", F.lit(0.0)).alias("neighbor_similarity"), F.coalesce(listed_ones, "did_you_mean", none).alias("did_you_mean"),
            F.when(F.col("match_type").isin("direct", "fuzzy", "exact_structure", "structural_neighbor"), F.lit("")).otherwise(recovered_id).alias("recovered_chebi_id"), note.alias("note"),
        )

    def resolve(self, queries: DataFrame, no_fuzzy: bool = False) -> DataFrame:
        """One compound for each query: status (resolved or unmapped), compound_id, chebi_accession, chebi_name, match_type, match_score,
        resolution_path, note, did_you_mean, recovered_chebi_id."""
        found = self.query(queries, 1, no_fuzzy)
        best = F.get("pathways", F.lit(0))
        compound = F.coalesce(best["compound_id"], F.get("mappings", F.lit(0))["compound_id"], F.lit(""))
        rows = found.withColumn("compound_id", compound).withColumn("_m", F.get(F.filter("mappings", lambda m: m["compound_id"] == F.col("compound_id")), F.lit(0)))
        on = (F.size("mappings") > 0) | (F.size("pathways") > 0)
        neighbor = (F.col("projection_type") == "structural_neighbor") | (F.col("match_type") == "structural_neighbor")
        score = F.when(F.col("match_type") == "exact_structure", 1.0).when(neighbor, F.col("neighbor_similarity")).otherwise(F.coalesce("_m.match_score", F.lit(0.0)))
        accession = F.coalesce("_m.chebi_accession", F.when(F.col("compound_id") != "", F.concat(F.lit("CHEBI:"), "compound_id")), F.lit(""))
        return rows.select(
            "qid", "query", F.when(on, "resolved").otherwise("unmapped").alias("status"), "compound_id", accession.alias("chebi_accession"), F.coalesce(best["chebi_name"], F.col("_m.chebi_name"), F.lit("")).alias("chebi_name"),
            "match_type", F.when(on, score).otherwise(0.0).alias("match_score"), "resolution_path", "note", "did_you_mean", "recovered_chebi_id",
        )

    def resolve_inputs(self, names: DataFrame, no_fuzzy: bool = False) -> DataFrame:
        """names (input_order, input_name, and a set's columns if there are several) with their resolution and whether the compound is
        in the universe of pathways. Every distinct name is resolved once."""
        distinct = names.select(F.col("input_name").alias("query")).distinct().withColumn("qid", F.col("query"))
        found = self.resolve(distinct, no_fuzzy).drop("qid").withColumnsRenamed({"query": "input_name", "status": "resolution_status"})
        universe = self.membership.select(F.col("member").alias("compound_id")).distinct().withColumn("_in", F.lit(True))
        rows = names.join(found, "input_name").join(universe, "compound_id", "left")
        inside = (F.col("resolution_status") == "resolved") & F.coalesce("_in", F.lit(False))
        outside = (F.col("resolution_status") == "resolved") & ~inside
        note = F.when(outside, F.trim(F.concat_ws(" ", "note", F.lit(NOTES["outside"])))).otherwise(F.col("note"))
        return rows.withColumns({"included_in_target": inside, "note": note}).drop("_in")

    def enrich(self, names: DataFrame, within: list[str] | None = None, no_fuzzy: bool = False, rerank=None) -> tuple[DataFrame, DataFrame]:
        """The resolved inputs, and the enriched pathways of each set of names with their ranks.

        rerank: a function that adds ml_score to candidate rows with features (see ``features``); without one, or where a set has
        fewer than two compounds, the baseline order stays and rerank_reason says why.
        """
        within = within or []
        inputs = self.resolve_inputs(names, no_fuzzy)
        targets = inputs.filter("included_in_target").select(*within, F.col("compound_id").alias("member"), "match_type", "match_score", F.coalesce(T.missing(F.col("chebi_name")), F.concat(F.lit("CHEBI:"), "compound_id")).alias("name"), "input_order")
        rows = stats.over_representation(self.membership.withColumnRenamed("pathway_id", "group_id"), targets, within=within).withColumnRenamed("group_id", "pathway_id")
        rows = with_support(rows.join(self.membership.select("pathway_id", "pathway_name").distinct(), "pathway_id"), self.support)
        small = F.col("n_target") < 2
        if rerank is None:
            rows = rows.withColumns({"ml_score": F.lit(None).cast("double"), "rerank_reason": F.when(small, "single_compound_query").otherwise("online_model_missing"), "model_kind": F.lit("")})
        else:
            rows = rerank(rows.join(self.features(targets, within), within) if within else rows.crossJoin(F.broadcast(self.features(targets, within))))
            rows = rows.withColumns({"ml_score": F.when(~small, F.col("ml_score")), "rerank_reason": F.when(small, "single_compound_query").otherwise("applied")})
        w = Window.partitionBy(*(within or [F.lit(1)])).orderBy(F.desc("ml_score"), F.desc("score"), "baseline_rank")
        rows = rows.withColumn("rerank_applied", F.col("ml_score").isNotNull())
        return inputs, rows.withColumn("ml_rank", F.when(F.col("rerank_applied"), F.row_number().over(w)))

    def features(self, targets: DataFrame, within: list[str]) -> DataFrame:
        """What a set's compounds are like among themselves, a row for each set."""
        return set_features(targets.select(*within, F.col("member").alias("compound_id")).distinct(), self.structures, self.parents, within)

    def small_sample(self, rows: DataFrame) -> str:
        """The warning of a set or universe that is too small, from one row of counts."""
        universe = self.membership.agg(F.count_distinct("member")).first()[0]
        size = rows.filter("included_in_target").agg(F.count_distinct("compound_id")).first()[0]
        few = universe < stats.SMALL_UNIVERSE or size < stats.SMALL_SET
        return f"small sample size (U={universe}, S={size}), enrichment results may be unreliable" if few else ""


def set_features(members: DataFrame, structures: DataFrame, parents: DataFrame, within: list[str]) -> DataFrame:
    """set_size, pairwise_tanimoto_mean, _max and _min, and the diversities of ontology roots, formulas and charges."""
    keys = within or ["_all"]
    rows = members if within else members.withColumn("_all", F.lit(1))
    tree = R.roots(parents, "child", "parent").select(F.col("child").alias("compound_id"), "root")
    known = rows.join(structures.select("compound_id", T.missing(F.col("formula_key")).alias("f"), T.missing(F.col("charge")).alias("c"), "fp"), "compound_id", "left").join(tree, "compound_id", "left")
    n = F.count_distinct("compound_id")
    sizes = known.groupBy(*keys).agg(n.cast("double").alias("set_size"), *[(F.count_distinct(c) / n).alias(f"{name}_diversity") for name, c in (("ontology", F.coalesce("root", "compound_id")), ("formula", F.col("f")), ("charge", F.col("c")))])
    pairs = ST.pairwise_similarity(rows.withColumnRenamed("compound_id", "member"), structures.withColumnRenamed("compound_id", "member").select("member", "fp"), keys)
    pairs = pairs.select(*keys, *[F.col(a).alias(f"pairwise_tanimoto_{b}") for a, b in (("mean", "mean"), ("most", "max"), ("least", "min"))])
    out = sizes.join(pairs, keys, "left").fillna(0.0)
    return out if within else out.drop("_all")


def membership(rows: DataFrame) -> DataFrame:
    """member, pathway_id and pathway_name (the last of the table, else the id) of AraCyc pathways with an id."""
    kept = rows.filter("source_db = 'AraCyc'").select(F.trim("compound_id").alias("member"), F.trim("pathway_id").alias("pathway_id"), F.trim("pathway_name").alias("n"), "_seq").filter("member <> '' and pathway_id <> ''")
    names = kept.groupBy("pathway_id").agg(F.max_by("n", "_seq").alias("n")).select("pathway_id", F.coalesce(T.missing(F.col("n")), F.col("pathway_id")).alias("pathway_name"))
    return kept.select("member", "pathway_id").distinct().join(names, "pathway_id")


def strict_names(compounds: DataFrame, names: DataFrame) -> DataFrame:
    """variant, key, compound_id of all English names of compounds."""
    own = compounds.select("compound_id", F.explode(F.array("name", "ascii_name")).alias("n"))
    more = names.filter(F.col("language_code").isin("", "en")).join(compounds.select("compound_id"), "compound_id", "left_semi").select("compound_id", F.explode(F.array("name", "ascii_name")).alias("n"))
    return R.name_index(own.union(more).filter("trim(n) <> ''"), "compound_id", "n").select("variant", "key", "compound_id")


def best_support(rows: DataFrame) -> DataFrame:
    """The best KEGG pathway of each AraCyc pathway."""
    scored = rows.filter("trim(aracyc_pathway_id) <> ''").withColumn("alignment_score", F.coalesce(T.missing(F.trim(F.col("alignment_score").cast("string"))).try_cast("double"), F.lit(0.0)))
    best = S.best_per_group(scored, ["aracyc_pathway_id"], [F.desc("alignment_score"), F.asc("_seq")])
    return best.select(F.col("aracyc_pathway_id").alias("pathway_id"), F.col("ath_pathway_id").alias("kegg_ath_pathway_id"), F.col("ath_pathway_name").alias("kegg_ath_pathway_name"), F.col("alignment_score").alias("kegg_alignment_score"), F.col("alignment_confidence").alias("kegg_alignment_confidence"))


def with_support(rows: DataFrame, support: DataFrame) -> DataFrame:
    met = rows.join(support, "pathway_id", "left").withColumn("kegg_support_present", F.col("kegg_ath_pathway_id").isNotNull())
    return met.withColumn("kegg_alignment_score", F.coalesce("kegg_alignment_score", F.lit(0.0))).fillna("", ["kegg_ath_pathway_id", "kegg_ath_pathway_name", "kegg_alignment_confidence"])


# --- Fixed values: columns of the set query's tables --------------------------------------------------------------------------------

INPUT_COLUMNS = ["input_order", "input_name", "resolution_status", "compound_id", "chebi_accession", "chebi_name", "match_type", "match_score", "resolution_path", "note", "did_you_mean", "included_in_target"]
ENRICHED_NAMES = {
    "n_hits": "x_i", "n_group": "K_i", "n_target": "n", "n_universe": "N", "expected": "expected_hits", "excess": "excess_hits", "enrichment": "enrichment_factor", "log_p": "neg_log10_p", "log_fdr": "neg_log10_fdr",
    "mapping_mean": "mapping_confidence_mean", "mapping_min": "mapping_confidence_min", "mapping_max": "mapping_confidence_max", "n_direct": "direct_hit_count", "n_fuzzy": "fuzzy_hit_count",
    "n_recovered": "recovered_hit_count", "n_exact_structure": "exact_structure_hit_count", "n_structural_neighbor": "structural_neighbor_hit_count", "score": "final_score", "confidence": "confidence_level",
    "hit_ids": "hit_compound_ids", "hit_names": "hit_compound_names",
}
ENRICHED_COLUMNS = [
    "pathway_id", "pathway_name", "baseline_rank", "ml_score", "ml_rank", "rerank_applied", "rerank_reason", "model_kind", "n_hits", "n_group", "n_target", "n_universe", "target_rate", "background_rate", "expected",
    "excess", "enrichment", "coverage", "p_value", "fdr", "log_p", "log_fdr", "mapping_mean", "mapping_min", "mapping_max", "n_direct", "n_fuzzy", "n_recovered", "n_exact_structure", "n_structural_neighbor", "score",
    "confidence", "hit_ids", "hit_names", "kegg_support_present", "kegg_ath_pathway_id", "kegg_ath_pathway_name", "kegg_alignment_score", "kegg_alignment_confidence",
]
_SIX = ["ml_score", "target_rate", "background_rate", "expected", "excess", "enrichment", "coverage", "p_value", "fdr", "log_p", "log_fdr", "mapping_mean", "mapping_min", "mapping_max"]


def write_set_query(engine: Engine, inputs: DataFrame, rows: DataFrame, prefix: str) -> None:
    """The three tables of a set query, and its warning in a JSON file beside them."""
    inputs.orderBy("input_order").select("input_name").write.mode("overwrite").text(f"{prefix}_input_compounds.txt")
    score = F.when(F.col("match_score") != 0, W.formatted(F.col("match_score"), ".4f")).otherwise("")
    W.write_tsv(inputs, f"{prefix}_metabolite_resolution.tsv", INPUT_COLUMNS, [F.asc("input_order")], {"match_score": score, "did_you_mean": F.array_join("did_you_mean", "; ")})
    aligned = F.when(F.col("kegg_support_present"), W.formatted(F.col("kegg_alignment_score"), ".6g")).otherwise("")
    formats = dict.fromkeys(_SIX, ".6g") | {"score": ".4f", "hit_names": F.array_join("hit_names", "; "), "kegg_alignment_score": aligned}
    W.write_tsv(rows, f"{prefix}_pathway_enrichment.tsv", ENRICHED_COLUMNS, [F.asc_nulls_last("ml_rank"), F.asc("baseline_rank")], formats, ENRICHED_NAMES)
    W.write_json(engine.spark, {"warning": engine.small_sample(inputs)}, f"{prefix}_warning.json")


def show(answer: dict | Y.Row, top_k: int = 10) -> str:
    """An answer's row as the text that a terminal shows."""
    a = answer.asDict(recursive=True) if isinstance(answer, Y.Row) else answer
    bar = "=" * 70
    out = ["", bar, f"Query: {a['query']}", bar]
    if a["match_type"]:
        out.append(f"match_type: {a['match_type']}")
        out += [f"projection_type: {a['projection_type']}"] if a["projection_type"] else []
    out += [f"{n}: {a[n]}" for n in ("resolution_path", "matched_compound", "recovered_chebi_id") if a[n]]
    if a["neighbor_similarity"] and a["match_type"] in ("exact_structure", "structural_neighbor"):
        out.append(f"neighbor_similarity: {a['neighbor_similarity']:.3f}")
    out += [f"note: {a['note']}"] if a["note"] else []
    out += ["did_you_mean:", *(f"  - {x}" for x in a["did_you_mean"])] if a["did_you_mean"] else []
    if not (a["mappings"] or a["pathways"] or a["expanded"]):
        return "\n".join(out)
    if a["mappings"]:
        out += ["", f"AraCyc/PlantCyc Mappings ({len(a['mappings'])} shown):"]
        for k, m in enumerate(a["mappings"][:5], 1):
            marks = (" [ChEBI xref]" if m["chebi_xref_direct"] else "") + (" [structure]" if m["structure_validated"] else "")
            out += [f"  {k}. {m['chebi_accession']} ({m['chebi_name']})", f"     -> {m['aracyc_compound_id']} ({m['aracyc_common_name']}) [{m['source_db']}]"]
            out += [f"     method={m['match_method']}, score={m['match_score']:.3f}{marks}", f"     pathways: {m['pathway_count']}"]
    if a["pathways"]:
        out += ["", f"Ranked Pathways (top {min(top_k, len(a['pathways']))}):"]
        for k, p in enumerate(a["pathways"][:top_k], 1):
            more = (f", genes={p['gene_count']}" if p["gene_count"] else "") + (f", EC={p['ec_numbers']}" if p["ec_numbers"] else "") + (f", similarity={p['support_similarity']:.3f}" if p["support_similarity"] < 0.999 else "")
            out += [f"  #{k} [{p['confidence_level']}] {p['pathway_name']}", f"     score={p['score']:.3f}, category={p['pathway_category']}{more}"]
            out.append(f"     via CHEBI:{p['compound_id']} -> {p['aracyc_compound_id']} [{p['source_db']}, {p['match_method']}]")
            if p["kegg_support_present"]:
                out.append(f"     KEGG ath support: {p['kegg_ath_pathway_id']} ({p['kegg_ath_pathway_name']}) [{p['kegg_alignment_confidence']}, score={p['kegg_alignment_score']:.4f}]")
    else:
        out += ["", "  No pathways found in primary chain."]
    if a["expanded"]:
        out += ["", f"Expanded Pathways [experimental] ({len(a['expanded'])}):"]
        out += [f"  - {x['pathway_name']} (ml_score={x['ml_score']:.3f}, {x['ml_confidence']})" for x in a["expanded"][:5]]
    return "\n".join(out)


def as_json(answer: Y.Row) -> str:
    return json.dumps(answer.asDict(recursive=True), ensure_ascii=False)
