"""The tables of compounds, records and pathways that the engine resolves, each as the columns its operators use.

Every reader takes the file's path. Cells are text, a missing one is the empty string, and sets are arrays without repeats in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..operators.select import best_per_group
from . import readers as R
from .readers import line_order

KEGG_ID, PUBCHEM_CID = r"^C\d{5}$", r"^\d+$"
#: Kinds of names that are aliases, with the source each becomes.
ALIAS_TYPES = {"SYNONYM": "chebi_synonym", "IUPAC NAME": "chebi_iupac", "INN": "chebi_inn"}


def _set(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(c, lambda x: x.isNotNull() & (x != ""))))


def _merged(c: Column) -> Column:
    """The distinct values of arrays of a group."""
    return _set(F.flatten(F.collect_list(c)))


def compounds(spark: SparkSession, path: str) -> DataFrame:
    """compound_id, chebi_accession, name, ascii_name, definition, stars, status_id, parent_id."""
    rows = R.tsv(spark, path, ["id", "chebi_accession", "name", "ascii_name", "definition", "stars", "status_id"], ["parent_id"])
    rows = best_per_group(rows, ["id"], [F.desc("_seq")])
    return rows.select(F.col("id").alias("compound_id"), "chebi_accession", "name", "ascii_name", "definition", F.coalesce(T.missing(F.col("stars")).try_cast("int"), F.lit(0)).alias("stars"), "status_id", "parent_id")


def comment_kinds(spark: SparkSession, path: str) -> DataFrame:
    return R.tsv(spark, path, ["datatype"])


def chebi_names(spark: SparkSession, path: str) -> DataFrame:
    """compound_id, type, language_code, name, ascii_name, _seq."""
    return R.tsv(spark, path, ["compound_id", "type", "language_code", "name", "ascii_name"])


def cross_references(spark: SparkSession, path: str) -> DataFrame:
    """compound_id and the sets kegg_ids, pubchem_cids, hmdb_ids, chemspider_ids."""
    rows = R.tsv(spark, path, ["compound_id", "accession_number", "source_id", "type"])
    a, source = F.trim("accession_number"), F.col("source_id")
    kinds = {
        "kegg_ids": F.when((source == C.XREF_KEGG) & a.rlike(KEGG_ID), a),
        "pubchem_cids": F.when((source == C.XREF_PUBCHEM) & (F.col("type") == "MANUAL_X_REF") & a.rlike(PUBCHEM_CID), a),
        "hmdb_ids": F.when((source == C.XREF_HMDB) & (a != ""), _hmdb(a)),
        "chemspider_ids": F.when((source == C.XREF_CHEMSPIDER) & (a != ""), a),
    }
    return rows.groupBy("compound_id").agg(*[F.array_sort(F.collect_set(c)).alias(name) for name, c in kinds.items()])


def _hmdb(c: Column) -> Column:
    return F.when(F.upper(c).startswith("HMDB"), c).otherwise(F.concat(F.lit("HMDB:"), c))


def formulas(spark: SparkSession, path: str) -> DataFrame:
    """compound_id, formula, formula_key, monoisotopic_mass, charge, exact_mass of the preferred row: status 1 first, then the first."""
    rows = R.tsv(spark, path, ["compound_id", "status_id", "formula", "monoisotopic_mass"], ["mass", "charge"])
    best = best_per_group(rows, ["compound_id"], [F.asc(F.when(F.col("status_id") == "1", 0).otherwise(1)), F.asc("_seq")])
    # A mass of 0 is none.
    mono = F.nullif(T.safe_float(F.col("monoisotopic_mass")), F.lit(0.0))
    return best.select(
        "compound_id", "formula", T.formula_key(F.col("formula")).alias("formula_key"), "monoisotopic_mass", T.charge(F.col("charge")).alias("charge"), F.coalesce(mono, T.safe_float(F.col("mass"))).alias("exact_mass")
    )


def structures(spark: SparkSession, path: str, formula_rows: DataFrame, by_status: bool = False) -> DataFrame:
    """compound_id, smiles, standard_inchi, standard_inchi_key and the formula's columns. The default structure comes first, for
    queries (by_status) then status 1, then the first row."""
    rows = R.tsv(spark, path, ["compound_id", "default_structure", "smiles", "standard_inchi", "standard_inchi_key"], ["status_id"])
    order = [F.asc(F.when(F.lower("default_structure") == "true", 0).otherwise(1))]
    order += [F.asc(F.when(F.col("status_id") == "1", 0).otherwise(1))] if by_status else []
    best = best_per_group(rows, ["compound_id"], [*order, F.asc("_seq")]).select("compound_id", "smiles", "standard_inchi", "standard_inchi_key")
    texts = ["formula", "formula_key", "monoisotopic_mass", "charge"]
    return best.join(formula_rows, "compound_id", "left").select(*best.columns, *[F.coalesce(c, F.lit("")).alias(c) for c in texts], "exact_mass")


def link_buckets(links: Column) -> dict[str, Column]:
    """Sets of ids by kind from a field of ``PREFIX:value`` items."""
    items = F.filter(T.split_multi(links), lambda x: x.contains(":"))
    pairs = F.transform(items, lambda x: F.struct(F.upper(F.trim(F.substring_index(x, ":", 1))).alias("p"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("v")))
    of = lambda *prefixes: F.transform(F.filter(pairs, lambda p: p["p"].isin(*prefixes) & (p["v"] != "")), lambda p: p["v"])
    return {
        "chebi_ids": _set(F.transform(of("CHEBI"), lambda v: T.prefixed_id(v, "CHEBI"))),
        "pubchem_cids": _set(F.filter(of("PUBCHEM"), lambda v: v.rlike(PUBCHEM_CID))),
        "kegg_ids": _set(F.filter(of("LIGAND-CPD", "KEGG", "CPD"), lambda v: v.rlike(KEGG_ID))),
        "hmdb_ids": _set(F.transform(of("HMDB"), _hmdb)),
    }


def _pmn_rows(spark: SparkSession, path: str) -> DataFrame:
    return R.tsv(spark, path, ["Compound_id", "Compound_common_name", "Compound_synonyms", "Chemical_formula", "Smiles", "Links", "Pathway"], ["EC", "Reaction_equation", "InChI_key", "Fingerprint"])


def pmn_compounds(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """One record for each (source_db, compound): single values from its first row, sets from all. files: (source_db, path).

    Besides the export's columns a table may bring InChI_key and Fingerprint (words of 64 bits, separated by blanks); inchi_key is
    else empty and fp null, and structure tiers find nothing.
    """
    parts = []
    for source, path in files:
        rows = _pmn_rows(spark, path).withColumn("source_db", F.lit(source))
        first = lambda c: F.min_by(F.col(c), F.col("_seq"))
        buckets = link_buckets(F.col("Links"))
        sets = rows.withColumns({"synonyms": T.split_multi(F.col("Compound_synonyms")), "pathways": F.array("Pathway"), **buckets})
        parts.append(
            sets.groupBy("source_db", F.col("Compound_id").alias("native_id")).agg(
                first("Compound_common_name").alias("common_name"),
                first("Chemical_formula").alias("formula"),
                first("Smiles").alias("smiles"),
                first("InChI_key").alias("inchi_key"),
                first("Fingerprint").alias("fingerprint"),
                *[_merged(F.col(c)).alias(c) for c in ("synonyms", "pathways", *buckets)],
                F.min("_seq").alias("_seq"),
            )
        )
    rows = reduce(DataFrame.unionByName, parts)
    return rows.withColumns(
        {
            "record_id": F.concat_ws(":", "source_db", "native_id"),
            "common_name": F.coalesce(T.missing(F.col("common_name")), F.col("native_id")),
            "formula_key": T.formula_key(F.col("formula")),
            "inchi_key": T.inchi_key(F.col("inchi_key")),
            "fp": words(F.col("fingerprint")),
        }
    ).drop("fingerprint")


def words(c: Column) -> Column:
    """A fingerprint's words from text; null for the empty string."""
    return F.when(F.trim(c) != "", F.transform(F.split(F.trim(c), r"\s+"), lambda w: w.cast("long")))


def pmn_details(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """source_db, native_id, pathway_name, ecs (set) and equations in order of the rows, of rows with a pathway."""
    parts = []
    for source, path in files:
        rows = _pmn_rows(spark, path).filter("Pathway <> ''")
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("_seq", F.col("Reaction_equation").alias("r")))), lambda x: x["r"])
        parts.append(
            rows.groupBy(F.lit(source).alias("source_db"), F.col("Compound_id").alias("native_id"), F.col("Pathway").alias("pathway_name")).agg(
                F.array_sort(F.collect_set(T.missing(F.col("EC")))).alias("ecs"), F.filter(ordered, lambda r: r != "").alias("equations")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def pmn_pathways(spark: SparkSession, path: str, source_db: str) -> DataFrame:
    """pathway_id, pathway_name (of the first row), source_db and sets of reactions, ECs, genes, gene names and proteins."""
    rows = R.tsv(spark, path, ["Pathway-id", "Pathway-name"], ["Reaction-id", "EC", "Gene-id", "Gene-name", "Protein-id"])
    sets = {"reaction_ids": "Reaction-id", "ec_numbers": "EC", "gene_ids": "Gene-id", "gene_names": "Gene-name", "protein_ids": "Protein-id"}
    return rows.groupBy(F.col("Pathway-id").alias("pathway_id")).agg(
        F.min_by(F.col("Pathway-name"), F.col("_seq")).alias("pathway_name"),
        F.lit(source_db).alias("source_db"),
        *[F.array_sort(F.collect_set(T.missing(F.col(f"`{c}`")))).alias(n) for n, c in sets.items()],
        F.min("_seq").alias("_seq"),
    )


def pmn_pathway_stats(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """source_db, name_key (normalised) and the sets names, pathway_ids, gene_ids of each pathway name."""
    parts = []
    for source, path in files:
        rows = R.tsv(spark, path, ["Pathway-id", "Pathway-name", "Gene-id"]).withColumn("name_key", T.normalize_name(F.col("Pathway-name"))).filter("name_key <> ''")
        parts.append(
            rows.groupBy(F.lit(source).alias("source_db"), "name_key").agg(
                *[F.array_sort(F.collect_set(T.missing(F.col(f"`{c}`")))).alias(n) for n, c in (("names", "Pathway-name"), ("pathway_ids", "Pathway-id"), ("gene_ids", "Gene-id"))]
            )
        )
    return reduce(DataFrame.unionByName, parts)


def pmn_pathway_ecs(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """source_db, name_key and the EC numbers of each pathway name."""
    parts = []
    for source, path in files:
        rows = R.tsv(spark, path, ["Pathway-name"], ["EC"]).withColumn("name_key", T.normalize_name(F.col("Pathway-name"))).filter("name_key <> ''")
        parts.append(rows.groupBy(F.lit(source).alias("source_db"), "name_key").agg(_merged(T.ec_numbers(F.col("EC"))).alias("ecs")))
    return reduce(DataFrame.unionByName, parts)


def lipid_records(spark: SparkSession, path: str) -> DataFrame:
    """LIPID MAPS records by record_id; a repeated id is its last record."""
    tag = lambda n: F.trim(F.coalesce(F.col("tags")[n], F.lit("")))
    ids = lambda n, pattern: _set(F.filter(T.split_multi(tag(n)), lambda v: v.rlike(pattern)))
    rows = R.sdf(spark, path).withColumn("_n", F.monotonically_increasing_id()).filter(tag("LM_ID") != "")
    rows = rows.withColumn("record_id", tag("LM_ID"))
    return best_per_group(rows, ["record_id"], [F.desc("_n")]).select(
        "record_id",
        tag("COMMON_NAME").alias("common_name"),
        tag("SYSTEMATIC_NAME").alias("systematic_name"),
        _set(T.split_multi(tag("SYNONYMS"))).alias("synonyms"),
        tag("INCHI_KEY").alias("inchi_key"),
        tag("SMILES").alias("smiles"),
        tag("FORMULA").alias("formula"),
        T.formula_key(tag("FORMULA")).alias("formula_key"),
        ids("PUBCHEM_CID", PUBCHEM_CID).alias("pubchem_cids"),
        ids("KEGG_ID", KEGG_ID).alias("kegg_ids"),
        _set(T.split_multi(tag("HMDB_ID"))).alias("hmdb_ids"),
        _set(F.transform(T.split_multi(tag("CHEBI_ID")), lambda v: T.prefixed_id(v, "CHEBI"))).alias("chebi_ids"),
        tag("CATEGORY").alias("category"),
        tag("MAIN_CLASS").alias("main_class"),
        tag("SUB_CLASS").alias("sub_class"),
    )


def pubchem_synonyms(spark: SparkSession, path: str, cids: DataFrame, most: int = C.PUBCHEM_SYNONYMS) -> DataFrame:
    """cid, synonym, place: of each wanted cid the first ``most`` good names that differ when normalised, in order of the file. The
    scan keeps wanted cids only, by a semi-join whose side is size-checked."""
    rows = R.listing(spark, path, ["cid", "synonym"]).join(cids.select("cid").distinct(), "cid", "left_semi").withColumn("synonym", F.trim("synonym"))
    good = rows.filter(T.good_synonym(F.col("synonym"))).withColumn("key", T.normalize_name(F.col("synonym"))).filter("key <> ''")
    once = good.groupBy("cid", "key").agg(F.min_by("synonym", "_seq").alias("synonym"), F.min("_seq").alias("_seq"))
    return once.withColumn("place", F.row_number().over(Window.partitionBy("cid").orderBy("_seq"))).filter(F.col("place") <= most).select("cid", "synonym", "place")


def pubchem_stats(spark: SparkSession, path: str, cids: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: target_cids, matched_lines, kept_synonyms."""
    wanted = cids.select("cid").distinct()
    lines = R.listing(spark, path, ["cid", "synonym"]).join(wanted, "cid", "left_semi").agg(F.count("*").alias("matched_lines"))
    return wanted.agg(F.count("*").alias("target_cids")).crossJoin(F.broadcast(lines)).crossJoin(F.broadcast(kept.agg(F.count("*").alias("kept_synonyms"))))


def kegg_compounds(spark: SparkSession, path: str) -> DataFrame:
    """kegg_id, primary_name, names (in order) of the compound list."""
    rows = R.listing(spark, path, ["kegg_id", "names"]).withColumn("names", F.filter(F.transform(F.split("names", ";"), lambda x: F.trim(x)), lambda x: x != ""))
    return rows.select("kegg_id", F.coalesce(F.get("names", F.lit(0)), F.col("kegg_id")).alias("primary_name"), "names")


def species_pathways(spark: SparkSession, path: str) -> DataFrame:
    """ath_pathway_id, ath_pathway_name (without the species) and the map_pathway_id it stands for."""
    rows = R.listing(spark, path, ["ath_pathway_id", "raw"])
    return rows.select("ath_pathway_id", F.substring_index("raw", " - ", 1).alias("ath_pathway_name"), F.concat(F.lit("map"), F.expr("substring(ath_pathway_id, 4)")).alias("map_pathway_id"))


def map_pathways(spark: SparkSession, path: str) -> DataFrame:
    return R.listing(spark, path, ["map_pathway_id", "map_pathway_name"]).drop("_seq")


def pathway_genes(spark: SparkSession, path: str) -> DataFrame:
    """pathway_id and gene_id (upper case) of a list of gene and pathway references, without their prefixes."""
    rows = R.listing(spark, path, ["gene", "pathway"])
    return rows.select(F.replace("pathway", F.lit("path:"), F.lit("")).alias("pathway_id"), F.upper(F.replace("gene", F.lit("ath:"), F.lit(""))).alias("gene_id")).distinct()


def compound_links(spark: SparkSession, path: str) -> DataFrame:
    """kegg_id and map_pathway_id of a list of compound and pathway references."""
    rows = R.listing(spark, path, ["compound", "pathway"])
    return rows.select(F.replace("compound", F.lit("cpd:"), F.lit("")).alias("kegg_id"), F.replace("pathway", F.lit("path:"), F.lit("")).alias("map_pathway_id")).distinct()


def reactome_names(spark: SparkSession, path: str) -> DataFrame:
    """name_key, reactome_id, species of all species' pathways, in order of the file by _seq."""
    rows = R.listing(spark, path, ["reactome_id", "name", "species"])
    return rows.select(T.normalize_name(F.col("name")).alias("name_key"), "reactome_id", "species", "_seq").filter("name_key <> ''")


REACTOME_COLUMNS = ["pathway_id", "pathway_name", "species", "top_level_category", "description", "release_date", "go_biological_process_id", "go_biological_process_name", "name_normalized", "name_compact"]


def plant_reactome_pathways(spark: SparkSession, path: str) -> DataFrame:
    rows = R.tsv(spark, path, ["pathway_id", "pathway_name"], REACTOME_COLUMNS[2:])
    return best_per_group(rows, ["pathway_id"], [F.desc("_seq")])


def plant_reactome_genes(spark: SparkSession, path: str) -> DataFrame:
    rows = R.tsv(spark, path, ["pathway_id", "gene_id"])
    return rows.filter("gene_id <> ''").select("pathway_id", F.upper("gene_id").alias("gene_id")).distinct()


def genes_to_processes(spark: SparkSession, gaf: str, obo: str) -> DataFrame:
    """gene_id, go_id, go_name: annotations to biological processes, the id for a name that the ontology lacks."""
    names = best_per_group(R.obo_terms(spark, obo), ["go_id"], [F.asc("name")]).select("go_id", F.coalesce(T.missing(F.col("name")), F.col("go_id")).alias("go_name"))
    return R.gaf_processes(spark, gaf).join(names, "go_id", "left").select("gene_id", "go_id", F.coalesce("go_name", "go_id").alias("go_name"))


def name_list(spark: SparkSession, path: str) -> DataFrame:
    """input_order (from 1) and input_name of a file of one name a line; blank lines don't count."""
    rows = spark.read.text(path).select(F.trim("value").alias("input_name"), line_order().alias("_seq")).filter("input_name <> ''")
    return rows.select(F.row_number().over(Window.orderBy("_seq")).alias("input_order"), "input_name")


def parents(spark: SparkSession, path: str) -> DataFrame:
    """child and parent of compounds with a parent."""
    return compounds(spark, path).filter("parent_id <> ''").select(F.col("compound_id").alias("child"), F.col("parent_id").alias("parent"))
