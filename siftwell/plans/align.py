"""Alignment of KEGG pathways with AraCyc pathways by names, genes and compounds, and a pathway's Plant Reactome companions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as T
from ..functions.numbers import exact_round
from ..operators import select as S
from ..sinks import tables as W
from ..sources import catalog as K
from ..sources import readers
from ..sources.paths import Paths
from .query import _letters

#: Weights of an alignment, and of a companion.
WEIGHTS = {"exact": 6.0, "name": 2.0, "jaccard": 4.0, "overlap": 3.0, "both": 1.0}
COMPANION = {"jaccard": 0.50, "overlap": 0.20, "name": 0.15, "species": 0.10, "category": 0.05}
SPECIES, COMPACT_NAME = "Arabidopsis thaliana", 0.97
TOP, COMPANIONS = 5, 3
COLUMNS = [
    "ath_pathway_id", "ath_pathway_name", "rank", "aracyc_pathway_id", "aracyc_pathway_name", "alignment_score", "alignment_confidence", "name_exact", "name_similarity", "shared_gene_count", "ath_gene_count",
    "aracyc_gene_count", "gene_jaccard", "gene_overlap_coefficient", "shared_compound_count", "ath_compound_count", "aracyc_compound_count", "compound_jaccard", "compound_overlap_coefficient",
]


def confidence(exact: Column, score: Column, genes: Column, compounds: Column) -> Column:
    return F.when((exact == 1) | ((score >= 6.0) & (genes > 0)), "high").when((score >= 4.0) & ((genes > 0) | (compounds > 0)), "medium").otherwise("low")


def _shared(kind: str, ath: DataFrame, ara: DataFrame) -> DataFrame:
    """How many members of a kind pairs share, for pairs that share any: an equi-join on the member."""
    both = ath.select("ath_pathway_id", "member").distinct().join(ara.select("aracyc_pathway_id", "member").distinct(), "member")
    return both.groupBy("ath_pathway_id", "aracyc_pathway_id").agg(F.count("*").alias(f"shared_{kind}_count"))


def _sized(pathways: DataFrame, key: str, kind: str, members: DataFrame) -> DataFrame:
    sizes = members.groupBy(key).agg(F.count_distinct("member").alias(f"{key[:-11]}_{kind}_count"))
    return pathways.join(sizes, key, "left").fillna(0, [f"{key[:-11]}_{kind}_count"])


def align(ath: DataFrame, aracyc: DataFrame, ath_genes: DataFrame, aracyc_genes: DataFrame, ath_compounds: DataFrame, aracyc_compounds: DataFrame, top_k: int = TOP) -> DataFrame:
    """The top_k AraCyc pathways of each KEGG pathway. ath, aracyc: id and name; the others: id and member.

    Every pair counts, as names alone can align: a stated set of KEGG pathways against all others. Genes and compounds come from
    equi-joins. How like two names are at most follows from their letters, so only pairs that may still reach the k-th best without
    it are compared letter by letter.
    """
    a = ath.select("ath_pathway_id", "ath_pathway_name").withColumn("a_key", T.fold_ascii(F.col("ath_pathway_name")))
    b = aracyc.select("aracyc_pathway_id", "aracyc_pathway_name").withColumn("b_key", T.fold_ascii(F.col("aracyc_pathway_name")))
    for kind, x, y in (("gene", ath_genes, aracyc_genes), ("compound", ath_compounds, aracyc_compounds)):
        a, b = _sized(a, "ath_pathway_id", kind, x), _sized(b, "aracyc_pathway_id", kind, y)
    a, b = a.withColumn("a_letters", _letters(F.col("a_key"))), b.withColumn("b_letters", _letters(F.col("b_key")))
    rows = a.crossJoin(b)
    for kind, x, y in (("gene", ath_genes, aracyc_genes), ("compound", ath_compounds, aracyc_compounds)):
        rows = rows.join(_shared(kind, x, y), ["ath_pathway_id", "aracyc_pathway_id"], "left").fillna(0, [f"shared_{kind}_count"])
        n, left, right = F.col(f"shared_{kind}_count"), F.col(f"ath_{kind}_count"), F.col(f"aracyc_{kind}_count")
        rows = rows.withColumns({f"{kind}_jaccard": F.when(left + right - n > 0, n / (left + right - n)).otherwise(0.0), f"{kind}_overlap_coefficient": F.when(F.least(left, right) > 0, n / F.least(left, right)).otherwise(0.0)})
    rows = rows.withColumn("name_exact", (F.col("a_key") == F.col("b_key")).cast("int"))

    def total(name: Column) -> Column:
        parts = [WEIGHTS["exact"] * F.col("name_exact"), WEIGHTS["name"] * name]
        for kind in ("gene", "compound"):
            parts += [WEIGHTS["jaccard"] * F.col(f"{kind}_jaccard"), WEIGHTS["overlap"] * F.col(f"{kind}_overlap_coefficient")]
        both = F.when((F.col("shared_gene_count") > 0) & (F.col("shared_compound_count") > 0), WEIGHTS["both"]).otherwise(0.0)
        return reduce(lambda x, y: x + y, [*parts, both])

    length = F.length("a_key") + F.length("b_key")
    named = (F.length("a_key") > 0) & (F.length("b_key") > 0)
    common = F.aggregate(F.zip_with("a_letters", "b_letters", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    rows = rows.withColumn("likest", F.when(named, 2 * common / length).otherwise(0.0))
    rows = rows.withColumns({"low": total(F.lit(0.0)), "high": total(F.col("likest"))})
    kth = F.nth_value("low", top_k).over(Window.partitionBy("ath_pathway_id").orderBy(F.desc("low")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("kth", kth).filter(F.col("kth").isNull() | (F.col("high") >= F.col("kth") - 1e-9))
    rows = rows.withColumn("name_similarity", F.when(named, sim.sequence_ratio(F.when(named, F.col("a_key")), F.when(named, F.col("b_key")))).otherwise(0.0))
    rows = rows.withColumn("alignment_score", total(F.col("name_similarity")))
    rows = rows.withColumn("alignment_confidence", confidence(F.col("name_exact"), F.col("alignment_score"), F.col("shared_gene_count"), F.col("shared_compound_count")))
    order = [F.desc("alignment_score"), F.desc("name_exact"), F.desc("shared_gene_count"), F.desc("shared_compound_count"), F.desc("name_similarity"), F.asc("aracyc_gene_count"), F.desc("aracyc_pathway_id")]
    return S.top_per_group(rows, ["ath_pathway_id"], order, top_k).select(*COLUMNS)


def compound_sets(links: DataFrame, ath: DataFrame, kegg_ids: DataFrame) -> DataFrame:
    """ath_pathway_id and member: compounds of KEGG pathways. kegg_ids: kegg_id and compound_id."""
    return links.join(ath.select("ath_pathway_id", "map_pathway_id"), "map_pathway_id").join(kegg_ids, "kegg_id").select("ath_pathway_id", F.col("compound_id").alias("member")).distinct()


def run(spark: SparkSession, paths: Paths, top_k: int = TOP) -> DataFrame:
    """Aligns a built work folder's pathways and writes the table of alignments and that of the best."""
    ath = S.best_per_group(K.species_pathways(spark, paths.ref("kegg_pathway_ath.tsv")), ["ath_pathway_id"], [F.asc("ath_pathway_name")])
    genes = K.pathway_genes(spark, paths.ref("kegg_ath_gene_pathway.tsv")).select(F.col("pathway_id").alias("ath_pathway_id"), F.col("gene_id").alias("member"))
    rows = readers.tsv(spark, paths.pmn(spark, "aracyc_pathways"), ["Pathway-id", "Pathway-name"], ["Gene-id"])
    rows = rows.select(F.trim("`Pathway-id`").alias("aracyc_pathway_id"), F.trim("`Pathway-name`").alias("name"), F.upper(F.trim("`Gene-id`")).alias("member"), "_seq").filter("aracyc_pathway_id <> '' and name <> ''")
    aracyc = rows.groupBy("aracyc_pathway_id").agg(F.max_by("name", "_seq").alias("aracyc_pathway_name"))
    entities = readers.tsv(spark, paths.index("step1_result.tsv"), ["compound_id", "kegg_ids"]).filter("trim(compound_id) <> ''")
    ids = entities.select(F.trim("compound_id").alias("compound_id"), F.explode(F.split("kegg_ids", ";")).alias("kegg_id")).withColumn("kegg_id", F.trim("kegg_id")).filter("kegg_id <> ''")
    of_ath = compound_sets(K.compound_links(spark, paths.ref("kegg_compound_pathway.tsv")), ath, ids)
    member = readers.tsv(spark, paths.index("aracyc_compound_pathway_index.tsv"), ["compound_id", "source_db", "pathway_id"]).filter("source_db = 'AraCyc' and pathway_id <> ''")
    of_ara = member.select(F.col("pathway_id").alias("aracyc_pathway_id"), F.col("compound_id").alias("member"))
    found = align(ath, aracyc, genes, rows.filter("member <> ''"), of_ath, of_ara, top_k)
    where = paths.index("stages/alignment")
    found.write.mode("overwrite").parquet(where)
    found = spark.read.parquet(where)
    formats = {c: ".6f" for c, kind in found.dtypes if kind == "double"}
    W.write_tsv(found, paths.index("kegg_ath_to_aracyc_pathway_alignment.tsv"), COLUMNS, [F.asc("ath_pathway_id"), F.asc("rank")], formats)
    W.write_tsv(found.filter("rank = 1"), paths.index("kegg_ath_to_aracyc_pathway_best.tsv"), COLUMNS, [F.asc("ath_pathway_id")], formats)
    return found


def summary(found: DataFrame) -> DataFrame:
    """One row: pathways, exact names, and best alignments with genes, with compounds and by confidence."""
    return found.filter("rank = 1").agg(
        F.count("*").alias("n_pathways"), F.count_if(F.col("name_exact") == 1).alias("n_exact"), F.count_if(F.col("shared_gene_count") > 0).alias("n_genes"), F.count_if(F.col("shared_compound_count") > 0).alias("n_compounds"),
        *[F.count_if(F.col("alignment_confidence") == c).alias(f"n_{c}") for c in ("high", "medium", "low")],
    )


def companions(pathways: DataFrame, genes: DataFrame, reactome: DataFrame, reactome_genes: DataFrame, top_k: int = COMPANIONS) -> DataFrame:
    """The top_k Plant Reactome pathways of each pathway. pathways: pathway_id, pathway_name, brite_l1 to brite_l3; genes: pathway_id,
    gene_id; reactome: as read; reactome_genes: pathway_id, gene_id.

    A companion has the same name (with or without blanks), two common genes, or a twentieth of all genes in common: candidates come
    from joins on names and on genes.
    """
    names = pathways.withColumn("v", T.variants(F.col("pathway_name"))).select("pathway_id", "pathway_name", "brite_l1", "brite_l2", "brite_l3", F.col("v.exact").alias("exact"), F.col("v.compact").alias("compact"))
    other = reactome.withColumn("w", T.variants(F.col("pathway_name"))).select(
        F.col("pathway_id").alias("plant_reactome_id"), F.col("pathway_name").alias("reactome_name"), "species", "top_level_category", "description",
        F.coalesce(T.missing(F.col("name_normalized")), F.col("w.exact")).alias("r_exact"), F.coalesce(T.missing(F.col("name_compact")), F.col("w.compact")).alias("r_compact"),
    )
    own = genes.select("pathway_id", F.col("gene_id").alias("member")).distinct()
    theirs = reactome_genes.select(F.col("pathway_id").alias("plant_reactome_id"), F.col("gene_id").alias("member")).distinct()
    shared = own.join(theirs, "member").groupBy("pathway_id", "plant_reactome_id").agg(F.count("*").alias("gene_overlap_count"))
    by_name = [names.filter(f"{c} <> ''").join(other, F.col(c) == F.col(f"r_{c}")).select("pathway_id", "plant_reactome_id") for c in ("exact", "compact")]
    pairs = reduce(DataFrame.unionByName, [*by_name, shared.select("pathway_id", "plant_reactome_id")]).distinct()
    rows = pairs.join(names, "pathway_id").join(other, "plant_reactome_id").join(shared, ["pathway_id", "plant_reactome_id"], "left")
    rows = rows.join(own.groupBy("pathway_id").agg(F.count("*").alias("n_own")), "pathway_id", "left").join(theirs.groupBy("plant_reactome_id").agg(F.count("*").alias("n_theirs")), "plant_reactome_id", "left")
    rows = rows.fillna(0, ["gene_overlap_count", "n_own", "n_theirs"])
    n = F.col("gene_overlap_count")
    union = F.col("n_own") + F.col("n_theirs") - n
    rows = rows.withColumns({"gene_jaccard": F.when(union > 0, n / union).otherwise(0.0), "overlap_ratio_kegg": F.when(F.col("n_own") > 0, n / F.col("n_own")).otherwise(0.0)})
    same, same_compact = (F.col("exact") != "") & (F.col("exact") == F.col("r_exact")), (F.col("compact") != "") & (F.col("compact") == F.col("r_compact"))
    rows = rows.filter(same | same_compact | (n >= 2) | (F.col("gene_jaccard") >= 0.05))
    dice = sim.dice(T.name_tokens(F.col("exact")), T.name_tokens(T.normalize_name(F.col("reactome_name"))))
    left = T.plant_context_tags(F.col("brite_l1"), F.col("brite_l2"), F.col("brite_l3"), F.col("pathway_name"))
    right = T.plant_context_tags(F.lit(""), F.col("top_level_category"), F.lit(""), F.col("reactome_name"), more=F.col("description"))
    rows = rows.withColumns({"name_similarity": F.when(same, 1.0).when(same_compact, COMPACT_NAME).otherwise(dice), "category": F.arrays_overlap(left, right).cast("double"), "native": F.col("species") == SPECIES})
    score = COMPANION["jaccard"] * F.col("gene_jaccard") + COMPANION["overlap"] * F.col("overlap_ratio_kegg") + COMPANION["name"] * F.col("name_similarity") + COMPANION["species"] * F.col("native").cast("double") + COMPANION["category"] * F.col("category")
    rows = rows.withColumn("raw", score).withColumn("alignment_confidence", F.when((F.col("raw") >= 0.55) & (n >= 3), "high").when((F.col("raw") >= 0.35) & (n >= 2), "medium").otherwise("low"))
    rows = rows.withColumns({"alignment_score": exact_round(F.col("raw")), **{c: exact_round(F.col(c)) for c in ("gene_jaccard", "overlap_ratio_kegg", "name_similarity")}})
    best = S.top_per_group(rows, ["pathway_id"], [F.desc("alignment_score"), F.desc("gene_overlap_count"), F.desc("native"), F.desc("reactome_name"), F.asc("plant_reactome_id")], top_k)
    return best.select("pathway_id", "rank", "plant_reactome_id", F.col("reactome_name").alias("pathway_name"), "species", "top_level_category", "description", "alignment_score", "alignment_confidence", "gene_overlap_count", "gene_jaccard", "overlap_ratio_kegg", "name_similarity")
