"""The batch build: names and structures of compounds, their records, pathways, annotations and scores, each stage a DataFrame.

A stage takes and gives tables; ``run`` writes those that later stages read to Parquet and the final ones as tab-separated text.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import stats
from ..functions import text as T
from ..functions.numbers import exact_round
from ..operators import resolve as R
from ..operators import select as S
from ..operators import structure as ST
from ..sinks import tables as W
from ..sources import catalog as K
from ..sources.paths import Paths, exists

VERSION = "aracyc_first_v1"
#: Weights of a pathway's score.
SCORE = {"match": 0.30, "xref": 0.12, "structure": 0.08, "genes": 0.12, "specificity": 0.10, "ec": 0.06, "reaction": 0.04, "more_reactions": 0.02, "more_reactions_most": 0.05, "cofactor": -0.12, "plantcyc": 0.05, "go": 0.02, "high": 0.03, "medium": 0.015}
REACTOME_LEAST, REACTOME_HIGH = 0.6, 0.8


@dataclass
class Standard:
    """What standardisation gives."""

    compounds: DataFrame
    xrefs: DataFrame
    structures: DataFrame
    records: DataFrame
    lipids: DataFrame
    base_aliases: DataFrame
    aliases: DataFrame
    matched_records: DataFrame
    matched_lipids: DataFrame
    cids: DataFrame
    resolutions: DataFrame
    counts: dict[str, int] = field(default_factory=dict)


def _forms(names: DataFrame, name: str = "raw_name") -> DataFrame:
    """Adds the four variants of a name; rows without any go."""
    v = T.variants(F.col(name))
    return names.withColumn("_v", v).withColumns({n: F.col(f"_v.{n}") for n in T.VARIANTS}).drop("_v").filter("exact <> ''")


def _deduped(aliases: DataFrame) -> DataFrame:
    """One alias for each compound and exact form: the heaviest source, then the first that came (stage, order)."""
    weighted = aliases.withColumn("weight", S.source_weight(F.col("source_type")))
    return S.best_per_group(weighted, ["compound_id", "exact"], [F.desc("weight"), F.asc("stage"), F.asc("at")])


def _alias(rows: DataFrame, name: Column, source: Column | str, stage: int, at: Column, language: Column | str = "") -> DataFrame:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return rows.select("compound_id", name.alias("raw_name"), lit(source).alias("source_type"), lit(language).alias("language_code"), F.lit(stage).alias("stage"), at.cast("string").alias("at"))


def base_aliases(compounds: DataFrame, names: DataFrame) -> DataFrame:
    """Aliases of compounds from their own names and the allowed kinds of English ones."""
    primary = _alias(compounds, F.col("name"), "compound_name", 0, F.lit("0"), "en")
    ascii_ = _alias(compounds.filter("ascii_name <> '' and ascii_name <> name"), F.col("ascii_name"), "ascii_name", 0, F.lit("1"), "en")
    source = F.create_map(*[F.lit(x) for pair in K.ALIAS_TYPES.items() for x in pair])
    kept = names.filter(F.col("type").isin(*K.ALIAS_TYPES) & F.col("language_code").isin("", "en")).join(compounds.select("compound_id"), "compound_id", "left_semi")
    own = _alias(kept, F.col("name"), source[F.col("type")], 1, F.concat("_seq", F.lit("/0")), F.col("language_code"))
    also = _alias(kept.filter("ascii_name <> '' and ascii_name <> name"), F.col("ascii_name"), source[F.col("type")], 1, F.concat("_seq", F.lit("/1")), F.col("language_code"))
    return _deduped(_forms(reduce(DataFrame.unionByName, [primary, ascii_, own, also])))


def _record_keys(records: DataFrame, names: list[Column], structure_key: bool) -> DataFrame:
    """record_id, kind, key: what a record can be matched by. Names that too many records share are out."""
    ids = [records.select("record_id", F.lit(kind).alias("kind"), F.explode(c).alias("key")) for kind, c in (("chebi", "chebi_ids"), ("pubchem", "pubchem_cids"), ("kegg", "kegg_ids"))]
    if structure_key:
        ids.append(records.filter("inchi_key <> ''").select("record_id", F.lit("inchi_key").alias("kind"), F.col("inchi_key").alias("key")))
    named = records.select("record_id", F.explode(F.concat(F.array(*names), F.col("synonyms"))).alias("n"))
    named = named.select("record_id", F.lit("name").alias("kind"), T.normalize_name(F.col("n")).alias("key")).filter("key <> ''").distinct()
    return reduce(DataFrame.unionByName, [*ids, R.unambiguous(named, "record_id")])


def external_matches(compound_keys: DataFrame, record_keys: DataFrame) -> DataFrame:
    """compound_id, record_id and the kinds of keys that matched: one equi-join for all kinds."""
    return compound_keys.join(record_keys, ["kind", "key"]).groupBy("compound_id", "record_id").agg(F.array_sort(F.collect_set("kind")).alias("methods"))


def standardise(spark: SparkSession, paths: Paths) -> Standard:
    """Names, structures and cross-references of compounds, merged with what matching records know, and the exact bridges."""
    compounds = K.compounds(spark, f"{paths.workdir}/compounds.tsv")
    base = base_aliases(compounds, K.chebi_names(spark, paths.ref("names.tsv.gz")))
    xrefs = K.cross_references(spark, paths.ref("database_accession.tsv.gz"))
    structures = K.structures(spark, paths.ref("structures.tsv.gz"), K.formulas(spark, paths.ref("chemical_data.tsv.gz")))
    records = K.pmn_compounds(spark, [("AraCyc", paths.pmn(spark, "aracyc_compounds")), ("PlantCyc", paths.pmn(spark, "plantcyc_compounds"))])
    lipids = K.lipid_records(spark, paths.ref("lmsd_extended.sdf.zip"))
    wanted = [records.select(F.explode("pubchem_cids").alias("cid")), lipids.select(F.explode("pubchem_cids").alias("cid")), xrefs.select(F.explode("pubchem_cids").alias("cid"))]
    synonyms = K.pubchem_synonyms(spark, paths.ref("pubchem_cid_synonym_filtered.gz"), reduce(DataFrame.unionByName, wanted))
    return merge(compounds, base, xrefs, structures, records, lipids, synonyms)


def merge(compounds: DataFrame, base: DataFrame, xrefs: DataFrame, structures: DataFrame, records: DataFrame, lipids: DataFrame, synonyms: DataFrame) -> Standard:
    ids = compounds.join(xrefs, "compound_id", "left").join(structures.select("compound_id", "standard_inchi_key"), "compound_id", "left")
    keys = [
        ids.select("compound_id", F.lit("chebi").alias("kind"), F.col("chebi_accession").alias("key")),
        ids.select("compound_id", F.lit("pubchem").alias("kind"), F.explode("pubchem_cids").alias("key")),
        ids.select("compound_id", F.lit("kegg").alias("kind"), F.explode("kegg_ids").alias("key")),
        ids.filter("standard_inchi_key <> ''").select("compound_id", F.lit("inchi_key").alias("kind"), F.col("standard_inchi_key").alias("key")),
        base.select("compound_id", F.lit("name").alias("kind"), F.col("exact").alias("key")),
    ]
    keys = reduce(DataFrame.unionByName, keys)
    matched = external_matches(keys, _record_keys(records, [F.col("common_name")], False))
    matched_lipids = external_matches(keys, _record_keys(lipids, [F.col("common_name"), F.col("systematic_name")], True))
    with_records = matched.join(records, "record_id")
    with_lipids = matched_lipids.join(lipids, "record_id")
    prefix = F.when(F.col("source_db") == "AraCyc", "aracyc").otherwise("plantcyc")
    few = F.slice(F.array_sort("synonyms"), 1, C.RECORD_SYNONYMS)
    synonym_rows = lambda rows: rows.select("*", F.posexplode(few).alias("k", "synonym"))
    place = F.concat("record_id", F.lit("/1/"), F.lpad(F.col("k").cast("string"), 6, "0"))
    cids = reduce(
        DataFrame.unionByName,
        [f.select("compound_id", F.explode("pubchem_cids").alias("cid")) for f in (ids, with_records, with_lipids)],
    ).distinct()
    named = cids.join(synonyms, "cid")
    parts = [
        base.select("compound_id", "raw_name", "source_type", "language_code", "stage", "at"),
        _alias(with_records, F.col("common_name"), F.concat(prefix, F.lit("_common_name")), 3, F.concat("record_id", F.lit("/0"))),
        _alias(synonym_rows(with_records), F.col("synonym"), F.concat(prefix, F.lit("_synonym")), 3, place),
        _alias(with_lipids.filter("common_name <> ''"), F.col("common_name"), "lipidmaps_common_name", 4, F.concat("record_id", F.lit("/0"))),
        _alias(with_lipids.filter("systematic_name <> ''"), F.col("systematic_name"), "lipidmaps_systematic_name", 4, F.concat("record_id", F.lit("/00"))),
        _alias(synonym_rows(with_lipids), F.col("synonym"), "lipidmaps_synonym", 4, place),
        _alias(named, F.col("synonym"), "pubchem_synonym", 5, F.concat("cid", F.lit("/"), F.lpad(F.col("place").cast("string"), 6, "0"))),
    ]
    aliases = _deduped(_forms(reduce(DataFrame.unionByName, parts)))
    return Standard(compounds, xrefs, structures, records, lipids, base, aliases, matched, matched_lipids, cids, exact_bridges(compounds, xrefs, structures, records))


def exact_bridges(compounds: DataFrame, xrefs: DataFrame, structures: DataFrame, records: DataFrame) -> DataFrame:
    """compound_id, record_id, native_id, resolved_by: the first of InChIKey, ChEBI and KEGG that leads to AraCyc, by the record with
    the most pathways."""
    ara = records.filter("source_db = 'AraCyc'").select("record_id", "native_id", "inchi_key", "chebi_ids", "kegg_ids", F.size("pathways").alias("n"))

    def preferred(rows: DataFrame, first: list[str]) -> DataFrame:
        order = [*map(F.asc, first), F.desc("n"), F.asc("native_id"), F.asc("record_id")]
        return S.best_per_group(rows, ["compound_id"], order).select("compound_id", "record_id")

    keyed = structures.select("compound_id", T.inchi_key(F.col("standard_inchi_key")).alias("inchi_key")).filter("inchi_key <> ''")
    by_key = preferred(keyed.join(compounds.select("compound_id"), "compound_id", "left_semi").join(ara, "inchi_key"), [])
    by_chebi = preferred(compounds.select("compound_id", F.col("chebi_accession").alias("key")).join(ara.withColumn("key", F.explode("chebi_ids")), "key"), [])
    by_kegg = preferred(xrefs.join(compounds.select("compound_id"), "compound_id", "left_semi").select("compound_id", F.explode("kegg_ids").alias("key")).join(ara.withColumn("key", F.explode("kegg_ids")), "key"), ["key"])
    tiers = [(m, C.EXACT_BRIDGE_SCORES[m], f) for m, f in (("inchikey", by_key), ("chebi_xref", by_chebi), ("kegg_xref", by_kegg))]
    found = R.cascade(tiers, "compound_id", "record_id")
    return found.join(ara.select("record_id", "native_id"), "record_id").select("compound_id", "record_id", "native_id", F.col("method").alias("resolved_by"), "score")


def entity_table(s: Standard) -> DataFrame:
    """One row for each compound, and for each AraCyc record that no compound leads to."""
    ara = s.records.filter("source_db = 'AraCyc'")
    n_aliases = s.aliases.groupBy("compound_id").agg(F.count("*").alias("alias_count"))
    cids = s.cids.groupBy("compound_id").agg(F.array_sort(F.collect_set("cid")).alias("pubchem_cids"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    own = (
        s.compounds.join(s.xrefs.select("compound_id", "kegg_ids", "hmdb_ids"), "compound_id", "left")
        .join(cids, "compound_id", "left")
        .join(s.structures.select("compound_id", "formula", "formula_key", "smiles", "standard_inchi_key"), "compound_id", "left")
        .join(n_aliases, "compound_id", "left")
        .join(s.resolutions.join(ara.select("record_id", "pathways"), "record_id"), "compound_id", "left")
        .select(
            "compound_id", "chebi_accession", text("native_id").alias("aracyc_compound_id"), F.lit("chebi").alias("entity_source"), F.lit("non-ara").alias("ara_tag"), text("resolved_by").alias("resolved_by"),
            F.col("name").alias("display_name"), "ascii_name", "definition", *[text(c).alias(c) for c in ("formula", "formula_key", "smiles", "standard_inchi_key")],
            *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("kegg_ids", "pubchem_cids", "hmdb_ids")],
            F.coalesce("alias_count", F.lit(0)).alias("alias_count"), F.coalesce("pathways", F.array().cast("array<string>")).alias("pathways"),
        )
    )
    lone = native_records(s)
    aliases = native_aliases(lone).groupBy("record_id").agg(F.count("*").alias("alias_count"))
    cleaned = F.trim(T.clean_markup(F.col("common_name")))
    native = lone.join(aliases, "record_id", "left").select(
        F.lit("").alias("compound_id"), F.coalesce(F.array_min("chebi_ids"), F.lit("")).alias("chebi_accession"), F.col("native_id").alias("aracyc_compound_id"), F.lit("aracyc").alias("entity_source"),
        F.lit("ara").alias("ara_tag"), F.lit("native").alias("resolved_by"), F.col("common_name").alias("display_name"), F.coalesce(T.missing(cleaned), F.col("common_name")).alias("ascii_name"),
        F.lit("").alias("definition"), "formula", "formula_key", "smiles", F.col("inchi_key").alias("standard_inchi_key"), "kegg_ids", "pubchem_cids", "hmdb_ids",
        F.coalesce("alias_count", F.lit(0)).alias("alias_count"), "pathways",
    )
    return own.unionByName(native).withColumn("pathway_count", F.size("pathways"))


def native_records(s: Standard) -> DataFrame:
    """AraCyc records that no compound uses and that know no compound of the table."""
    ara = s.records.filter("source_db = 'AraCyc'")
    known = ara.select("record_id", F.explode("chebi_ids").alias("chebi_accession")).join(s.compounds.select("chebi_accession"), "chebi_accession", "left_semi")
    return ara.join(s.resolutions.select("record_id"), "record_id", "left_anti").join(known.select("record_id"), "record_id", "left_anti")


def native_aliases(records: DataFrame) -> DataFrame:
    rows = records.withColumn("compound_id", F.col("record_id"))
    cleaned = F.trim(T.clean_markup(F.col("common_name")))
    parts = [
        _alias(rows, F.col("common_name"), "aracyc_common_name", 0, F.lit("0"), "en"),
        _alias(rows.filter((cleaned != "") & (cleaned != F.col("common_name"))), cleaned, "aracyc_ascii_name", 1, F.lit("0"), "en"),
        _alias(rows.select("compound_id", F.posexplode(F.array_sort("synonyms")).alias("k", "synonym")), F.col("synonym"), "aracyc_synonym", 2, F.lpad(F.col("k").cast("string"), 9, "0"), "en"),
    ]
    return _deduped(_forms(reduce(DataFrame.unionByName, parts))).withColumnRenamed("compound_id", "record_id")


def alias_table(s: Standard, entities: DataFrame) -> DataFrame:
    head = ["compound_id", "chebi_accession", "aracyc_compound_id", "entity_source", "ara_tag", "resolved_by", "display_name"]
    shown = ["raw_name", "source_type", *T.VARIANTS]
    own = entities.filter("entity_source = 'chebi'").select(*head).join(s.aliases.select("compound_id", *shown), "compound_id")
    native = native_aliases(native_records(s)).withColumn("aracyc_compound_id", F.expr("substring(record_id, length('AraCyc:') + 1)")).select("aracyc_compound_id", *shown)
    native = entities.filter("entity_source = 'aracyc'").select(*head).join(native, "aracyc_compound_id").select(*head, *shown)
    return own.select(*head, *shown).unionByName(native)


def name_signatures(s: Standard) -> DataFrame:
    """Formulas and keys that each name (exact, compact) stands for, with the sources that say so."""
    own = s.base_aliases.join(s.structures.select("compound_id", "formula_key", F.col("standard_inchi_key").alias("key")), "compound_id").select("exact", "compact", "formula_key", "key", F.lit("ChEBI").alias("source"))
    of = lambda rows, names, key, source: _forms(rows.select(F.explode(F.concat(F.array(*names), F.col("synonyms"))).alias("raw_name"), "formula_key", key.alias("key"), source.alias("source"))).select("exact", "compact", "formula_key", "key", "source")
    pmn = of(s.records, [F.col("common_name")], F.lit(""), F.col("source_db"))
    lipid = of(s.lipids, [F.col("common_name"), F.col("systematic_name")], F.col("inchi_key"), F.lit("LIPID MAPS"))
    rows = reduce(DataFrame.unionByName, [own, pmn, lipid]).withColumn("key", T.inchi_key(F.col("key")))
    sets = {"formula_keys": F.col("formula_key"), "inchi_key_prefixes": T.inchi_block(F.col("key")), "inchi_key_fulls": F.col("key"), "evidence_sources": F.col("source")}
    return rows.filter("compact <> ''").groupBy(F.col("exact").alias("exact_name"), F.col("compact").alias("compact_name")).agg(*[F.array_sort(F.collect_set(T.missing(c))).alias(n) for n, c in sets.items()])


def reference_key(canonical_smiles: Column | None = None) -> Column:
    """What a record stands for among the reference compounds."""
    name = T.missing(T.normalize_name(F.col("common_name")))
    smiles = F.lit(None).cast("string") if canonical_smiles is None else T.missing(canonical_smiles)
    tagged = [("chebi", F.array_min("chebi_ids")), ("kegg", F.array_min("kegg_ids")), ("smiles", smiles), ("name", name), ("record", F.col("record_id"))]
    return F.coalesce(*[F.when(c.isNotNull(), F.concat(F.lit(f"{tag}:"), c)) for tag, c in tagged])


def match(s: Standard, fingerprints: DataFrame | None = None) -> DataFrame:
    """All candidate records of each compound, ranked: candidate_rank 1 is the match.

    The exact bridges come first; else, each only where the ones before found nothing: AraCyc by structure and by name, PlantCyc by
    identifiers, by structure and by name. fingerprints: compound_id and fp, where there are any.
    """
    records = s.records.select("record_id", "source_db", "native_id", "common_name", "pathways", "chebi_ids", "kegg_ids", "inchi_key", "formula_key", "fp", "smiles", reference_key().alias("reference_compound_key"))
    exact = s.resolutions.select("compound_id", "record_id", F.lit(1).alias("tier"), F.col("resolved_by").alias("method"), "score")
    open_ = s.compounds.select("compound_id").join(exact.select("compound_id"), "compound_id", "left_anti")
    forms = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(n).alias("variant"), F.col(n).alias("key")) for i, n in enumerate(T.VARIANTS)])
    names = s.aliases.join(open_, "compound_id", "left_semi").select("compound_id", F.explode(forms).alias("f")).select("compound_id", "f.*").filter("key <> ''").distinct()
    score_of = lambda scores, c: F.create_map(*[x for k, v in scores.items() for x in (F.lit(k), F.lit(v))])[c]
    rows = [exact]
    fps = open_.join(s.structures.select("compound_id", "formula_key"), "compound_id").join(fingerprints, "compound_id") if fingerprints is not None else None
    for source, tier, discount in (("AraCyc", 2, 1.0), ("PlantCyc", 5, C.FALLBACK_DISCOUNT)):
        mine = records.filter(F.col("source_db") == source)
        if fps is not None:
            near = ST.best_of_formula(fps, mine, C.STRUCTURE_LEAST)
            raw = exact_round(C.STRUCTURE_WEIGHT * F.col("similarity"))
            rows.append(near.select("compound_id", "record_id", F.lit(tier).alias("tier"), F.lit("tanimoto").alias("method"), raw.alias("score")))
        keyed = R.name_index(mine.select("record_id", F.explode(F.array(F.col("common_name"))).alias("n")).union(s.records.filter(F.col("source_db") == source).select("record_id", F.explode("synonyms"))), "record_id", "n")
        hits = names.join(keyed.select("record_id", "variant", "key"), ["variant", "key"])
        first = hits.groupBy("compound_id", "record_id").agg(F.min_by("variant", "rank").alias("variant"))
        rows.append(first.select("compound_id", "record_id", F.lit(tier + 1).alias("tier"), F.concat(F.lit("name_"), "variant").alias("method"), score_of(C.NAME_MATCH_SCORES, F.col("variant")).alias("score")))
        if source == "PlantCyc":
            ids = open_.join(s.xrefs.select("compound_id", "kegg_ids"), "compound_id", "left").join(s.structures.select("compound_id", T.inchi_key(F.col("standard_inchi_key")).alias("key")), "compound_id", "left")
            accession = F.explode(F.array(F.concat(F.lit("CHEBI:"), "compound_id"), F.col("compound_id"))).alias("k")
            found = [
                (0, "chebi_xref", ids.select("compound_id", accession).join(mine.select("record_id", F.explode("chebi_ids").alias("k")), "k")),
                (1, "kegg_xref", ids.select("compound_id", F.explode("kegg_ids").alias("k")).join(mine.select("record_id", F.explode("kegg_ids").alias("k")), "k")),
                (2, "inchikey", ids.filter("key <> ''").select("compound_id", F.col("key").alias("k")).join(mine.select("record_id", F.col("inchi_key").alias("k")), "k")),
            ]
            both = reduce(DataFrame.unionByName, [f.select("compound_id", "record_id", F.lit(i).alias("place"), F.lit(m).alias("method"), F.lit(C.FALLBACK_SCORES[m]).alias("score")) for i, m, f in found])
            once = both.groupBy("compound_id", "record_id").agg(F.min(F.struct("place", "method", "score")).alias("b"))
            rows.append(once.select("compound_id", "record_id", F.lit(4).alias("tier"), "b.method", "b.score"))
    found = reduce(DataFrame.unionByName, rows)
    best_tier = F.min("tier").over(Window.partitionBy("compound_id"))
    found = found.withColumn("_t", best_tier).filter("tier = _t").join(records, "record_id")
    discounted = F.when(F.col("tier") >= 4, exact_round(F.col("score") * C.FALLBACK_DISCOUNT)).otherwise(F.col("score"))
    found = found.select(
        "compound_id", F.col("native_id").alias("aracyc_compound_id"), F.col("common_name").alias("aracyc_common_name"), "source_db", F.col("method").alias("match_method"), discounted.alias("match_score"),
        (F.col("method") == "chebi_xref").alias("chebi_xref_direct"), F.col("method").isin("inchikey", "tanimoto").alias("structure_validated"), F.col("pathways"), F.col("record_id").alias("plant_record_id"), "reference_compound_key",
    )
    return ranked_matches(found)


def ranked_matches(rows: DataFrame) -> DataFrame:
    """Adds candidate_rank and candidate_count: by score, then AraCyc, structure, direct reference and the record's id."""
    order = [F.desc("match_score"), F.desc(F.col("source_db") == "AraCyc"), F.desc("structure_validated"), F.desc("chebi_xref_direct"), F.asc("aracyc_compound_id"), F.asc("plant_record_id")]
    w = Window.partitionBy("compound_id")
    return rows.withColumn("candidate_rank", F.row_number().over(w.orderBy(*order))).withColumn("candidate_count", F.count("*").over(w))


def pathway_info(aracyc: DataFrame, plantcyc: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Pathways with their sources, and name_key, exact_name, pathway_id to look names up.

    A PlantCyc pathway whose name (exact, else normalised) is known adds its source to that pathway and nothing else; the others are
    pathways of their own, the first of those that share a normalised name standing for all.
    """
    key = lambda f: f.withColumn("name_key", T.normalize_name(F.col("pathway_name")))
    ara = key(aracyc)
    exact = ara.groupBy(F.col("pathway_name").alias("exact_name")).agg(F.max_by("pathway_id", "_seq").alias("exact_id"))
    loose = ara.filter("name_key <> ''").groupBy("name_key").agg(F.min_by("pathway_id", "_seq").alias("loose_id"))
    info = ara.withColumn("source_dbs", F.array(F.lit("AraCyc")))
    if plantcyc is not None:
        own = key(plantcyc).join(exact, F.col("pathway_name") == F.col("exact_name"), "left").join(loose, "name_key", "left").withColumn("known", F.coalesce("exact_id", "loose_id"))
        group = F.coalesce(T.missing(F.col("name_key")), F.col("pathway_name"))
        fresh = own.filter("known is null").withColumn("rep", F.first("pathway_id").over(Window.partitionBy(group).orderBy("_seq")))
        also = own.filter("known is not null").select(F.col("known").alias("pathway_id")).distinct().withColumn("also", F.lit(True))
        info = info.join(also, "pathway_id", "left").withColumn("source_dbs", F.when(F.col("also"), F.array(F.lit("AraCyc"), F.lit("PlantCyc"))).otherwise(F.col("source_dbs"))).drop("also")
        new = fresh.filter("pathway_id = rep").join(ara.select("pathway_id"), "pathway_id", "left_anti").withColumn("source_dbs", F.array(F.lit("PlantCyc"))).select(info.columns)
        info = info.unionByName(new)
        more = own.filter("known is not null").select("pathway_name", "name_key", F.col("known").alias("pathway_id"), "_seq").unionByName(fresh.select("pathway_name", "name_key", F.col("rep").alias("pathway_id"), "_seq"))
        exact = exact.unionByName(more.join(exact, F.col("pathway_name") == F.col("exact_name"), "left_anti").groupBy(F.col("pathway_name").alias("exact_name")).agg(F.min_by("pathway_id", "_seq").alias("exact_id")))
        loose = loose.unionByName(more.filter("name_key <> ''").join(loose, "name_key", "left_anti").groupBy("name_key").agg(F.min_by("pathway_id", "_seq").alias("loose_id")))
    names = exact.select(F.lit("exact").alias("how"), F.col("exact_name").alias("name"), F.col("exact_id").alias("pathway_id")).unionByName(loose.select(F.lit("loose").alias("how"), F.col("name_key").alias("name"), F.col("loose_id").alias("pathway_id")))
    return info, names


def pathway_ids(rows: DataFrame, names: DataFrame, column: str = "pathway_name") -> DataFrame:
    """Adds pathway_id: by the exact name, else by the normalised one, else empty."""
    exact = names.filter("how = 'exact'").select(F.col("name").alias("_e"), F.col("pathway_id").alias("_eid"))
    loose = names.filter("how = 'loose'").select(F.col("name").alias("_l"), F.col("pathway_id").alias("_lid"))
    keyed = rows.withColumn("_k", T.normalize_name(F.col(column)))
    found = keyed.join(exact, F.col(column) == F.col("_e"), "left").join(loose, F.col("_k") == F.col("_l"), "left")
    return found.withColumn("pathway_id", F.coalesce("_eid", "_lid", F.lit(""))).drop("_e", "_eid", "_l", "_lid", "_k")


def path_key() -> Column:
    """What a pathway row is grouped by: its id, or its name where it has none."""
    return F.coalesce(T.missing(F.col("pathway_id")), F.col("pathway_name"))


def link(matches: DataFrame, info: DataFrame, names: DataFrame, details: DataFrame) -> DataFrame:
    """One row for each matched compound and pathway of its record."""
    rows = matches.filter("candidate_rank = 1").withColumn("pathway_name", F.explode(F.array_sort("pathways")))
    rows = pathway_ids(rows, names).join(details.withColumnRenamed("native_id", "aracyc_compound_id"), ["source_db", "aracyc_compound_id", "pathway_name"], "left")
    known = info.select("pathway_id", "reaction_ids", F.col("ec_numbers").alias("info_ecs"))
    none = F.array().cast("array<string>")
    return rows.join(known, "pathway_id", "left").select(
        *[c for c in matches.columns if c not in ("pathways", "candidate_rank", "candidate_count")],
        "pathway_id", "pathway_name",
        F.array_sort(F.array_union(F.coalesce("ecs", none), F.coalesce("info_ecs", none))).alias("ec_numbers"),
        F.coalesce("reaction_ids", none).alias("reaction_ids"),
        F.slice(F.coalesce("equations", none), 1, 5).alias("reaction_equations"),
    )


def go_enrichment(info: DataFrame, annotations: DataFrame, top: int = 5) -> DataFrame:
    """pathway_id, rank, go_id, go_name, p_value, fdr, n_hits, n_group, n_target, n_universe: the best processes of each pathway that
    has three genes before and after the background is applied."""
    membership = annotations.select(F.col("go_id").alias("group_id"), F.col("gene_id").alias("member")).distinct()
    genes = info.filter(F.size("gene_ids") >= 3).select("pathway_id", F.explode("gene_ids").alias("member")).join(membership.select("member").distinct(), "member", "left_semi")
    enough = genes.groupBy("pathway_id").agg(F.count("*").alias("_n")).filter("_n >= 3").select("pathway_id")
    rows = stats.over_representation(membership, genes.join(enough, "pathway_id", "left_semi"), min_hits=1, within=["pathway_id"])
    names = annotations.groupBy(F.col("go_id").alias("group_id")).agg(F.min("go_name").alias("go_name"))
    rows = rows.join(names, "group_id").withColumnRenamed("group_id", "go_id")
    best = S.top_per_group(rows, ["pathway_id"], [F.asc("fdr"), F.desc("n_hits"), F.asc("go_name"), F.asc("go_id")], top)
    return best.select("pathway_id", "rank", "go_id", "go_name", "p_value", "fdr", "n_hits", "n_group", "n_target", "n_universe")


def best_reactome(names: DataFrame, reactome: DataFrame, least: float = REACTOME_LEAST) -> DataFrame:
    """pathway_name, reactome_id, reactome_name, dice: the reactome pathway whose name's tokens are most like, if they are so by
    ``least``; ties to the first of the table."""
    tokens = lambda c: T.name_tokens(T.normalize_name(c))
    other = reactome.select(F.col("pathway_id").alias("reactome_id"), F.col("pathway_name").alias("reactome_name"), "_seq")
    pairs = R.token_dice_join(names.select("pathway_name").distinct(), "pathway_name", tokens(F.col("pathway_name")), other, "reactome_id", tokens(F.col("reactome_name")), least)
    return S.best_per_group(pairs.join(other, "reactome_id"), ["pathway_name"], [F.desc("dice"), F.asc("_seq")]).drop("_seq")


def annotate(hits: DataFrame, info: DataFrame, go: DataFrame | None, reactome: DataFrame | None, blank_reactome: bool = False) -> DataFrame:
    """Adds category, genes, counts, the best process, the likest Reactome pathway, cofactor_like and the annotation's confidence.

    blank_reactome: as a known version that reads a column which isn't there and so never finds a Reactome pathway.
    """
    counts = hits.groupBy(path_key().alias("_key")).agg(F.count_distinct("compound_id").alias("compound_count"))
    known = info.select("pathway_id", F.col("gene_ids"), F.col("gene_names"), F.size("reaction_ids").alias("_n_reactions"), "source_dbs")
    rows = hits.withColumn("_key", path_key()).join(counts, "_key").join(known, "pathway_id", "left")
    if go is not None:
        rows = rows.join(go.filter("rank = 1").select("pathway_id", F.col("go_name").alias("go_best_term"), F.col("fdr").alias("go_best_fdr")), "pathway_id", "left")
    else:
        rows = rows.withColumns({"go_best_term": F.lit(None).cast("string"), "go_best_fdr": F.lit(None).cast("double")})
    if reactome is not None and not blank_reactome:
        rows = rows.join(best_reactome(hits, reactome), "pathway_name", "left")
    else:
        rows = rows.withColumns({"reactome_id": F.lit(None).cast("string"), "reactome_name": F.lit(None).cast("string"), "dice": F.lit(None).cast("double")})
    none = F.array().cast("array<string>")
    rows = rows.withColumns(
        {
            "gene_ids": F.coalesce("gene_ids", none),
            "gene_names": F.coalesce("gene_names", none),
            "reaction_count": F.coalesce("_n_reactions", F.size("reaction_ids")),
            "pathway_category": T.first_category(F.col("pathway_name")),
            "go_best_term": F.coalesce("go_best_term", F.lit("")),
            "go_best_fdr": F.coalesce("go_best_fdr", F.lit(1.0)),
            "plant_reactome_best_id": F.coalesce("reactome_id", F.lit("")),
            "plant_reactome_best_name": F.coalesce("reactome_name", F.lit("")),
            "plant_reactome_alignment_score": F.coalesce("dice", F.lit(0.0)),
            "plant_reactome_alignment_confidence": F.when(F.col("dice") >= REACTOME_HIGH, "high").when(F.col("dice") >= REACTOME_LEAST, "medium").otherwise(""),
            "cofactor_like": T.cofactor_like(F.col("aracyc_compound_id"), F.col("aracyc_common_name")),
            "plantcyc_corroboration": F.coalesce((F.col("source_db") == "AraCyc") & F.array_contains("source_dbs", "AraCyc") & F.array_contains("source_dbs", "PlantCyc"), F.lit(False)),
        }
    ).withColumn("gene_count", F.size("gene_ids"))
    strong = [F.col("gene_count") > 0, F.col("go_best_term") != "", F.col("plant_reactome_alignment_confidence") != "", F.col("match_score") >= 0.90]
    n = sum((s.cast("int") for s in strong[1:]), strong[0].cast("int"))
    return rows.withColumn("annotation_confidence", F.when(n >= 3, "high").when(n >= 1, "medium").otherwise("low")).drop("_key", "_n_reactions", "source_dbs", "reactome_id", "reactome_name", "dice")


def short_number(c: Column) -> Column:
    """A number of at most four decimals as the shortest text that reads back as it."""
    plain = F.regexp_replace(F.format_string("%.4f", c), "0+$", "")
    return F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)


def signed(c: Column) -> Column:
    return F.format_string("%+.3f", exact_round(F.abs(c), 3) * F.signum(c))


def score(rows: DataFrame, most_compounds: DataFrame | None = None, most_genes: DataFrame | None = None) -> DataFrame:
    """Adds the thirteen contributions (a struct in their order), their sum as the score, and the level.

    most_compounds, most_genes: one row each of the largest numbers of compounds and genes of any pathway; by default of these rows.
    """
    a = most_compounds if most_compounds is not None else rows.agg(F.max("compound_count").alias("most_compounds"))
    b = most_genes if most_genes is not None else rows.agg(F.max("gene_count").alias("most_genes"))
    rows = rows.crossJoin(F.broadcast(a.select(F.coalesce("most_compounds", F.lit(1)).alias("most_compounds")))).crossJoin(F.broadcast(b.select(F.coalesce("most_genes", F.lit(1)).alias("most_genes"))))
    specificity = F.when(F.col("most_compounds") > 0, 1 - F.log1p("compound_count") / F.log1p("most_compounds")).otherwise(0.5)
    genes = F.when(F.col("most_genes") > 0, F.log1p("gene_count") / F.log1p("most_genes")).otherwise(0.0)
    on = lambda c, weight: F.when(c, F.lit(float(weight))).otherwise(0.0)
    graded = lambda c: F.when(c == "high", SCORE["high"]).when(c == "medium", SCORE["medium"]).otherwise(0.0)
    parts = {
        "match_confidence": exact_round(SCORE["match"] * F.col("match_score")),
        "chebi_xref_direct": on(F.col("chebi_xref_direct"), SCORE["xref"]),
        "structure_validated": on(F.col("structure_validated"), SCORE["structure"]),
        "gene_support": exact_round(SCORE["genes"] * genes),
        "pathway_specificity": exact_round(SCORE["specificity"] * specificity),
        "ec_support": on(F.size("ec_numbers") > 0, SCORE["ec"]),
        "reaction_present": on(F.col("reaction_count") > 0, SCORE["reaction"]),
        "multi_reaction_bonus": exact_round(F.least(F.lit(SCORE["more_reactions_most"]), SCORE["more_reactions"] * F.log1p("reaction_count"))),
        "cofactor_penalty": on(F.col("cofactor_like"), SCORE["cofactor"]),
        "plantcyc_corroboration": on(F.col("plantcyc_corroboration"), SCORE["plantcyc"]),
        "plant_reactome_alignment": graded(F.col("plant_reactome_alignment_confidence")),
        "go_enrichment_bonus": on(F.col("go_best_term") != "", SCORE["go"]),
        "annotation_quality": graded(F.col("annotation_confidence")),
    }
    rows = rows.withColumn("contributions", F.struct(*[c.alias(n) for n, c in parts.items()]))
    total = reduce(lambda x, y: x + y, [F.col(f"contributions.{n}") for n in parts])
    rows = rows.withColumn("score", R.clamp(total)).drop("most_compounds", "most_genes")
    level = F.when((F.col("score") >= 0.65) & (F.col("gene_count") > 0) & (F.col("match_score") >= 0.90), "high").when(F.col("score") >= 0.35, "medium").otherwise("low")
    return rows.withColumn("confidence_level", level)


def contribution_texts(rows: DataFrame) -> DataFrame:
    """Adds the JSON of the contributions and the labels of the three most positive and most negative."""
    names = rows.schema["contributions"].dataType.names
    entries = F.array(*[F.struct(F.col(f"contributions.{n}").alias("v"), F.lit(n).alias("k")) for n in names])
    json = F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda e: F.concat(F.lit('"'), e["k"], F.lit('": '), short_number(e["v"]))), ", "), F.lit("}"))
    label = lambda es: F.array_join(F.transform(F.slice(es, 1, 3), lambda e: F.concat(e["k"], F.lit("("), signed(e["v"]), F.lit(")"))), ", ")
    up = F.reverse(F.array_sort(F.filter(entries, lambda e: e["v"] > 0)))
    down = F.array_sort(F.filter(entries, lambda e: e["v"] < 0))
    return rows.withColumns({"feature_contributions_json": json, "top_positive_features": label(up), "top_negative_features": label(down)})


def reason() -> Column:
    two, three = (lambda c, n: F.format_string(f"%.{n}f", exact_round(c, n)) for _ in range(2))
    parts = [
        F.concat(F.lit("AraCyc match: "), "aracyc_compound_id", F.lit(" ("), "match_method", F.lit(", score="), two(F.col("match_score"), 2), F.lit(")")),
        F.concat(F.lit("pathway="), "pathway_name"),
        F.concat(F.lit("category="), "pathway_category"),
        F.when(F.col("gene_count") > 0, F.concat(F.lit("genes="), F.col("gene_count").cast("string"))),
        F.when(F.size("ec_numbers") > 0, F.concat(F.lit("EC="), F.array_join(F.slice("ec_numbers", 1, 3), ";"))),
        F.when(F.col("cofactor_like"), F.lit("cofactor_like")),
        F.concat(F.lit("final_score="), three(F.col("score"), 3), F.lit(" ("), "confidence_level", F.lit(")")),
    ]
    return F.concat_ws("; ", *parts)


def rank(scored: DataFrame, compounds: DataFrame) -> DataFrame:
    """The best row of each compound and pathway, ranked by score; equal scores by the pathway's name."""
    best = S.best_per_group(scored.withColumn("_key", path_key()), ["compound_id", "_key"], [F.desc("score"), F.asc("pathway_name")])
    ranked = best.withColumn("pathway_rank", F.row_number().over(Window.partitionBy("compound_id").orderBy(F.desc("score"), F.asc("pathway_name"), F.asc("_key"))))
    ranked = contribution_texts(ranked.withColumn("reason", reason())).drop("_key", "contributions")
    named = ranked.join(compounds.select("compound_id", F.col("name").alias("chebi_name")), "compound_id")
    return named.withColumns(
        {
            "chebi_accession": F.concat(F.lit("CHEBI:"), "compound_id"),
            "score": exact_round(F.col("score")),
            "evidence_type": F.when(F.col("source_db") == "AraCyc", "primary_aracyc").otherwise("plantcyc_fallback"),
            "aracyc_compound_name": F.col("aracyc_common_name"),
            "gene_ids": F.slice("gene_ids", 1, 10),
            "plant_reactome_best_category": F.col("plant_reactome_best_name"),
        }
    )


# --- Fixed values: columns of the written tables ---------------------------------------------------------------------------------

ALIAS_COLUMNS = ["compound_id", "chebi_accession", "chebi_name", "alias", "source_type", "normalized_name", "compact_name", "singular_name", "stereo_stripped_name"]
NAME_INDEX_COLUMNS = ["compound_id", "chebi_accession", "canonical_name", "alias", "source_type", "is_primary_name", "exact_name", "compact_name", "singular_name", "stereo_stripped_name"]
SIGNATURE_COLUMNS = ["exact_name", "compact_name", "formula_keys", "formula_count", "inchi_key_prefixes", "inchi_key_prefix_count", "inchi_key_fulls", "inchi_key_full_count", "evidence_sources"]
ENTITY_COLUMNS = [
    "compound_id", "chebi_accession", "aracyc_compound_id", "entity_source", "ara_tag", "resolved_by", "display_name", "ascii_name", "definition", "formula", "formula_key", "smiles", "standard_inchi_key",
    "kegg_ids", "pubchem_cids", "hmdb_ids", "alias_count", "pathway_count", "pathways",
]
UNIFIED_ALIAS_COLUMNS = ["compound_id", "chebi_accession", "aracyc_compound_id", "entity_source", "ara_tag", "resolved_by", "display_name", "alias", "alias_source", "normalized_name", "compact_name", "singular_name", "stereo_stripped_name"]
MATCH_COLUMNS = ["compound_id", "chebi_accession", "chebi_name", "aracyc_compound_id", "aracyc_common_name", "source_db", "match_method", "match_score", "chebi_xref_direct", "structure_validated", "pathway_count", "pathways"]
STRUCTURE_COLUMNS = ["compound_id", "chebi_accession", "aracyc_compound_id", "source_db", "match_method", "match_score"]
CANDIDATE_COLUMNS = [
    "compound_id", "chebi_accession", "chebi_name", "selection_status", "candidate_count", "candidate_rank", "is_selected", "aracyc_compound_id", "aracyc_common_name", "source_db", "match_method", "match_score",
    "chebi_xref_direct", "structure_validated", "pathway_count", "pathways", "plant_record_id", "reference_compound_key",
]
PATHWAY_COLUMNS = ["compound_id", "chebi_accession", "aracyc_compound_id", "source_db", "pathway_id", "pathway_name", "ec_numbers", "reaction_count", "match_method", "match_score"]
RAW_HIT_COLUMNS = [
    "compound_id", "chebi_accession", "chebi_name", "hit_rank", "aracyc_compound_id", "aracyc_common_name", "source_db", "match_method", "match_score", "chebi_xref_direct", "structure_validated", "plant_record_id",
    "reference_compound_key", "pathway_id", "pathway_name", "ec_numbers", "reaction_ids", "reaction_equations",
]
ANNOTATION_COLUMNS = [
    "compound_id", "chebi_accession", "aracyc_compound_id", "source_db", "pathway_id", "pathway_name", "pathway_category", "gene_count", "gene_ids", "ec_numbers", "reaction_count", "compound_count", "go_best_term",
    "go_best_fdr", "plant_reactome_best_name", "plant_reactome_alignment_confidence", "annotation_confidence", "cofactor_like",
]
OUTPUT_COLUMNS = [
    "compound_id", "chebi_accession", "chebi_name", "pathway_rank", "score", "confidence_level", "evidence_type", "match_method", "match_score", "aracyc_compound_id", "aracyc_compound_name", "source_db", "pathway_id",
    "pathway_name", "pathway_category", "gene_count", "gene_ids", "ec_numbers", "reaction_count", "compound_count", "go_best_term", "go_best_fdr", "plant_reactome_best_category", "plant_reactome_alignment_confidence",
    "annotation_confidence", "chebi_xref_direct", "structure_validated", "cofactor_like", "top_positive_features", "top_negative_features", "feature_contributions_json", "reason",
]

_VARIANT_NAMES = {"exact": "normalized_name", "compact": "compact_name", "singular": "singular_name", "stereo_stripped": "stereo_stripped_name"}


def _by_id(*more: Column) -> list[Column]:
    return [F.expr("try_cast(compound_id as bigint)"), F.asc("compound_id"), *more]


def write_names(s: Standard, paths: Paths) -> dict[str, DataFrame]:
    """Writes the tables of names; gives the entity and alias tables as they are read later."""
    named = s.aliases.join(s.compounds.select("compound_id", "chebi_accession", F.col("name").alias("chebi_name")), "compound_id").withColumnRenamed("raw_name", "alias").withColumnsRenamed(_VARIANT_NAMES)
    W.write_tsv(named, f"{paths.workdir}/outputs/chebi_aliases_standardized.tsv", ALIAS_COLUMNS, _by_id(F.asc("source_type"), F.asc("alias")))
    index = named.withColumns({"canonical_name": F.col("chebi_name"), "is_primary_name": F.col("source_type") == "compound_name", "exact_name": F.col("normalized_name")})
    W.write_tsv(index, paths.index("name_normalization_index.tsv"), NAME_INDEX_COLUMNS, _by_id(F.asc("source_type"), F.asc("alias")))
    signatures = name_signatures(s).withColumns({f"{n}_count": F.size(c) for n, c in (("formula", "formula_keys"), ("inchi_key_prefix", "inchi_key_prefixes"), ("inchi_key_full", "inchi_key_fulls"))})
    W.write_tsv(signatures, paths.index("name_to_formula_index.tsv"), SIGNATURE_COLUMNS, [F.asc("exact_name"), F.asc("compact_name")])
    entities = entity_table(s)
    own_first = [F.asc(F.col("entity_source") == "aracyc"), *_by_id(F.asc("aracyc_compound_id"))]
    W.write_tsv(entities, paths.index("step1_result.tsv"), ENTITY_COLUMNS, own_first)
    aliases = alias_table(s, entities).withColumnsRenamed({"raw_name": "alias", "source_type": "alias_source", **_VARIANT_NAMES})
    W.write_tsv(aliases, paths.index("step1_alias_unified.tsv"), UNIFIED_ALIAS_COLUMNS, [*own_first, F.asc("alias_source"), F.asc("alias")])
    return {"entities": entities, "aliases": aliases}


def write_matches(matches: DataFrame, compounds: DataFrame, paths: Paths) -> None:
    named = compounds.select("compound_id", F.col("name").alias("chebi_name")).withColumn("chebi_accession", F.concat(F.lit("CHEBI:"), "compound_id"))
    best = matches.filter("candidate_rank = 1").join(named, "compound_id").withColumn("pathway_count", F.size("pathways"))
    four = {"match_score": ".4f"}
    sorted_paths = {"pathways": F.array_join(F.array_sort("pathways"), ";")}
    W.write_tsv(best, paths.index("name_to_aracyc_index.tsv"), MATCH_COLUMNS, _by_id(), four | sorted_paths)
    W.write_tsv(best.filter("structure_validated"), paths.index("compound_structure_aracyc_index.tsv"), STRUCTURE_COLUMNS, _by_id(), four)
    all_ = named.join(matches, "compound_id", "left").withColumns(
        {
            "selection_status": F.when(F.col("candidate_rank").isNull(), "no_match").when(F.col("candidate_rank") == 1, "selected").otherwise("not_selected"),
            "is_selected": F.coalesce(F.col("candidate_rank") == 1, F.lit(False)),
            "candidate_count": F.coalesce("candidate_count", F.lit(0)),
            **{c: F.coalesce(c, F.lit(False)) for c in ("chebi_xref_direct", "structure_validated")},
            "pathway_count": F.coalesce(F.size("pathways"), F.lit(0)),
        }
    )
    W.write_tsv(all_.withColumn("pathway_count", F.greatest("pathway_count", F.lit(0))), paths.index("aracyc_match_candidates.tsv"), CANDIDATE_COLUMNS, _by_id(F.asc("candidate_rank")), four | sorted_paths)


def write_hits(hits: DataFrame, compounds: DataFrame, paths: Paths) -> None:
    place = F.row_number().over(Window.partitionBy("compound_id").orderBy("pathway_name"))
    rows = hits.join(compounds.select("compound_id", F.col("name").alias("chebi_name")), "compound_id", "left")
    rows = rows.withColumns({"chebi_accession": F.concat(F.lit("CHEBI:"), "compound_id"), "hit_rank": place, "reaction_count": F.size("reaction_ids")})
    W.write_tsv(rows, paths.index("aracyc_compound_pathway_index.tsv"), PATHWAY_COLUMNS, _by_id(F.asc("hit_rank")), {"match_score": ".4f"})
    W.write_tsv(rows, paths.index("aracyc_raw_pathway_hits.tsv"), RAW_HIT_COLUMNS, _by_id(F.asc("hit_rank")), {"match_score": ".4f", "reaction_equations": F.array_join("reaction_equations", " ; ")})


def write_annotations(rows: DataFrame, paths: Paths) -> None:
    fdr = F.when(F.col("go_best_fdr") < 1.0, W.formatted(F.col("go_best_fdr"), ".6f")).otherwise("")
    shown = rows.withColumns({"chebi_accession": F.concat(F.lit("CHEBI:"), "compound_id"), "gene_ids": F.slice("gene_ids", 1, 10)})
    W.write_tsv(shown, paths.index("aracyc_pathway_annotation_index.tsv"), ANNOTATION_COLUMNS, _by_id(F.asc("pathway_name")), {"go_best_fdr": fdr})


def write_output(ranked: DataFrame, paths: Paths) -> None:
    fdr = F.when((F.col("go_best_fdr") < 1.0) & (F.col("go_best_fdr") != 0), W.formatted(F.col("go_best_fdr"), ".6g")).otherwise("")
    W.write_tsv(ranked, f"{paths.tables}/chebi_pathways_aracyc_refactored.tsv", OUTPUT_COLUMNS, _by_id(F.asc("pathway_rank")), {"score": ".4f", "match_score": ".4f", "go_best_fdr": fdr})


def metadata(s: Standard, matches: DataFrame, info: DataFrame, ranked: DataFrame, counts: dict[str, int]) -> dict[str, object]:
    """What the run's two JSON files say."""
    ara = s.records.filter("source_db = 'AraCyc'").select(reference_key().alias("k")).agg(F.count_distinct("k")).first()[0]
    best = matches.filter("candidate_rank = 1")
    with_path = best.filter("source_db = 'AraCyc'").join(ranked.select("compound_id").distinct(), "compound_id", "left_semi").agg(F.count_distinct("reference_compound_key")).first()[0]
    n_compounds, n_rows = s.compounds.count(), ranked.count()
    status = {f"matched_{r.source_db.lower()}": r.n for r in best.groupBy("source_db").agg(F.count("*").alias("n")).collect()}
    left = n_compounds - sum(status.values())
    return {
        "preprocess_version": VERSION,
        "pipeline": "aracyc_first",
        "coverage_basis": "aracyc_reference_compounds",
        "total_compounds": ara,
        "chebi_input_total": n_compounds,
        "compounds_with_pathway": with_path,
        "coverage_pct": round(100 * with_path / max(ara, 1), 2),
        "total_pathway_rows": n_rows,
        "aracyc_pathway_count": info.count(),
        "aracyc_mapping_status": status | ({"no_match": left} if left else {}),
        "pathway_status": {"with_pathway": with_path, "without_pathway": max(ara - with_path, 0)},
        "preprocess_counts": counts,
    }


_STAGES = ("compounds", "xrefs", "structures", "records", "lipids", "base_aliases", "aliases", "matched_records", "matched_lipids", "cids", "resolutions")


def load(spark: SparkSession, paths: Paths) -> Standard:
    """What standardisation gave in a built work folder."""
    return Standard(*[stage(spark, paths, name) for name in _STAGES])


def stage(spark: SparkSession, paths: Paths, name: str) -> DataFrame:
    """A table that a build kept: those of standardisation, matches, pathways, pathway_names, hits, go, annotated, ranked."""
    return spark.read.parquet(paths.index(f"stages/{name}"))


def run(spark: SparkSession, paths: Paths, fingerprints: DataFrame | None = None, blank_reactome: bool = False) -> dict[str, object]:
    """The whole build from a work folder's files to its tables; gives the metadata. Stages that feed several others are written to
    Parquet beside the indexes and read again."""
    paths.check(spark)

    def kept(name: str, rows: DataFrame) -> DataFrame:
        where = paths.index(f"stages/{name}")
        rows.write.mode("overwrite").parquet(where)
        return spark.read.parquet(where)

    s = standardise(spark, paths)
    for name in _STAGES:
        setattr(s, name, kept(name, getattr(s, name)))
    tables = write_names(s, paths)
    matches = kept("matches", match(s, fingerprints))
    write_matches(matches, s.compounds, paths)
    optional = paths.pmn(spark, "plantcyc_pathways")
    info, names = pathway_info(K.pmn_pathways(spark, paths.pmn(spark, "aracyc_pathways"), "AraCyc"), K.pmn_pathways(spark, optional, "PlantCyc") if exists(spark, optional) else None)
    info, names = kept("pathways", info), kept("pathway_names", names)
    files = [("AraCyc", paths.pmn(spark, "aracyc_compounds")), ("PlantCyc", paths.pmn(spark, "plantcyc_compounds"))]
    hits = kept("hits", link(matches, info, names, K.pmn_details(spark, files)))
    write_hits(hits, s.compounds, paths)
    gaf, obo = paths.ref("gene_association.tair.gz"), paths.ref("go-basic.obo")
    go = kept("go", go_enrichment(info, K.genes_to_processes(spark, gaf, obo))) if exists(spark, gaf) and exists(spark, obo) else None
    reactome = paths.ref("plant_reactome_pathways.tsv")
    annotated = kept("annotated", annotate(hits, info, go, K.plant_reactome_pathways(spark, reactome) if exists(spark, reactome) else None, blank_reactome))
    write_annotations(annotated, paths)
    ranked = kept("ranked", rank(score(annotated, most_genes=info.agg(F.max(F.size("gene_ids")).alias("most_genes"))), s.compounds))
    write_output(ranked, paths)
    counts = {
        "compounds_total": s.compounds.count(),
        "step1_result_rows": tables["entities"].count(),
        "step1_alias_unified_rows": tables["aliases"].count(),
        "step1_exact_aracyc_resolved": s.resolutions.count(),
        "step2a_aracyc_matched": matches.filter("candidate_rank = 1").count(),
        "step2a_candidate_audit_rows": matches.count() + s.compounds.join(matches, "compound_id", "left_anti").count(),
        "step3a_compounds_with_pathways": hits.select("compound_id").distinct().count(),
        "step3a_total_pathway_hits": hits.count(),
        "step4a_annotated_hits": annotated.count(),
        "step7a_output_rows": ranked.count(),
    }
    counts |= {f"step1_resolved_{r.resolved_by}": r.n for r in s.resolutions.groupBy("resolved_by").agg(F.count("*").alias("n")).collect()}
    found = metadata(s, matches, info, ranked, counts)
    W.write_json(spark, found, paths.index("preprocess_metadata.json"))
    profile = {r.value: r.n for r in S.profile(K.comment_kinds(spark, f"{paths.workdir}/comments.tsv"), "datatype").orderBy(F.desc("n")).collect()}
    summary = {"compounds_total": found["total_compounds"], "chebi_input_total": found["chebi_input_total"], "alias_rows": s.aliases.count(), "comments_profile": profile, "mapping_status": found["aracyc_mapping_status"], "pathway_status": found["pathway_status"], "coverage_basis": found["coverage_basis"]}
    W.write_json(spark, summary, f"{paths.workdir}/outputs/summary.json")
    return found
