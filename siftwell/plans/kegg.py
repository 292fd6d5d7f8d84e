"""Compounds to KEGG compounds by all evidence there is, and KEGG pathways with their scores.

Evidence is one long table with an order of arrival; candidates are its aggregation, and the selection is windows over these.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..functions.numbers import exact_round
from ..operators import resolve as R
from ..operators import select as S
from ..sinks import tables as W
from ..sources import catalog as K
from ..sources import readers
from ..sources.paths import Paths
from . import build
from .build import Standard

#: Scores of the kinds of evidence, and of a pathway.
XREF, KEY_CHEBI, KEY_OTHER = 0.995, 0.985, 0.980
LIPID = {"structure": 0.97, "crossref": 0.96, "pubchem": 0.94, "name": 0.88}
SAME_FORMULA, NAME_MOST, STANDARD_BONUS = 0.01, 0.98, 0.03
EDIT_BASE, EDIT_BONUS, EDIT_MOST = 0.78, 0.02, 0.94
PATHWAY = {"mapping": 0.45, "specificity": 0.15, "ath": 0.12, "genes": 0.10, "xref": 0.05, "structure": 0.05, "aracyc": 0.06, "plantcyc": 0.04, "generic": -0.06, "fallback": -0.10}
GLOBAL_MAPS = "Global and overview maps"
_EVIDENCE = {
    "alias": "", "source_type": "", "variant": "", "direct": False, "primary": False, "external": "", "structure": False, "pubchem": False, "bridge_method": "", "bridge_source": "", "ara": False,
}


def structure_keys(s: Standard) -> DataFrame:
    """kind (inchikey or smiles), key, kegg_id and the set of sources that link a structure to a KEGG compound. SMILES are as supplied:
    tables that bring canonical ones match by them."""
    own = s.xrefs.join(s.structures.select("compound_id", T.inchi_key(F.col("standard_inchi_key")).alias("inchikey"), F.trim("smiles").alias("smiles")), "compound_id").withColumn("source", F.lit("ChEBI"))
    lipid = s.lipids.select("kegg_ids", T.inchi_key(F.col("inchi_key")).alias("inchikey"), F.trim("smiles").alias("smiles"), F.lit("LIPID MAPS").alias("source"))
    rows = own.select("kegg_ids", "inchikey", "smiles", "source").unionByName(lipid).withColumn("kegg_id", F.explode("kegg_ids"))
    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("key")) for k in ("inchikey", "smiles")])).alias("k")
    return rows.select("kegg_id", "source", keys).select("k.kind", "k.key", "kegg_id", "source").filter("key <> ''").groupBy("kind", "key", "kegg_id").agg(F.array_sort(F.collect_set("source")).alias("sources"))


def bridge_confidence(score: Column) -> Column:
    return F.when(score >= 0.93, "high").when(score >= 0.88, "medium").otherwise("low")


def bridges(s: Standard, keys: DataFrame) -> DataFrame:
    """Matched records' ways to KEGG compounds: the best of five methods for each record and KEGG compound, with what else supports it."""
    records = s.matched_records.select("compound_id", "record_id").join(s.records, "record_id")
    chebi = s.compounds.join(s.xrefs, "compound_id").select(F.col("chebi_accession").alias("via"), F.explode("kegg_ids").alias("kegg_id"))
    pubchem = s.xrefs.select(F.explode("pubchem_cids").alias("via"), "kegg_ids").select("via", F.explode("kegg_ids").alias("kegg_id")).distinct()
    base = ["compound_id", "record_id", "source_db", "native_id", "chebi_ids", "pubchem_cids", "kegg_ids"]
    said = F.concat("source_db", F.lit(" record "), "native_id")
    text = lambda *parts: F.concat(said, *[F.lit(p) if isinstance(p, str) and p.startswith(" ") else F.col(p) if isinstance(p, str) else p for p in parts])
    by = lambda kind: keys.filter(F.col("kind") == kind).select(F.col("key").alias("via"), "kegg_id", F.array_join("sources", ",").alias("sources"))
    rows = [
        (0, "plant_direct_kegg_xref", False, records.withColumn("kegg_id", F.explode("kegg_ids")), F.concat(F.lit("KEGG:"), "kegg_id"), text(" carries direct KEGG link ", "kegg_id")),
        (1, "plant_via_chebi", False, records.withColumn("via", F.explode("chebi_ids")).join(chebi, "via"), F.col("via"), text(" bridges to ", "kegg_id", " via ", "via")),
        (2, "plant_inchikey_exact", True, records.filter("inchi_key <> ''").withColumn("via", F.col("inchi_key")).join(by("inchikey"), "via"), F.concat(F.lit("InChIKey:"), "via"), text(" exact InChIKey matches ", "kegg_id", " via ", "sources")),
        (3, "plant_via_pubchem", False, records.withColumn("via", F.explode("pubchem_cids")).join(pubchem, "via"), F.concat(F.lit("PUBCHEM:"), "via"), text(" bridges to ", "kegg_id", " via PUBCHEM:", "via")),
        (4, "plant_smiles_exact", True, records.filter("trim(smiles) <> ''").withColumn("via", F.trim("smiles")).join(by("smiles"), "via"), F.concat(F.lit("SMILES:"), "via"), text(" canonical SMILES matches ", "kegg_id", " via ", "sources")),
    ]
    parts = []
    for place, method, structure, frame, support, reason in rows:
        ara, plant = C.PLANT_BRIDGE_BASE_SCORES[method]
        parts.append(
            frame.select(
                *base, "kegg_id", F.lit(place).alias("place"), F.lit(method).alias("method"), F.when(F.col("source_db") == "AraCyc", ara).otherwise(plant).alias("base"), support.alias("support"),
                F.lit(structure).alias("structure"), reason.alias("reason"),
            )
        )
    found = reduce(DataFrame.unionByName, parts)
    extra = lambda method, ids: F.when((F.col("method") != method) & (F.size(ids) > 0), 1).otherwise(0)
    more = extra("plant_direct_kegg_xref", "kegg_ids") + extra("plant_via_chebi", "chebi_ids") + extra("plant_via_pubchem", "pubchem_cids")
    found = found.withColumn("score", F.least(F.col("base") + F.least(more, F.lit(3)) * 0.01, F.col("base") + 0.03))
    # A later method replaces what was found before, with its support, only where it scores more; else it adds its own.
    w = Window.partitionBy("compound_id", "record_id", "kegg_id")
    first = F.first(F.struct("place", "method", "score", "structure")).over(w.orderBy(F.desc("score"), "place"))
    found = found.withColumn("best", first).filter("place >= best.place")
    return found.groupBy("compound_id", "record_id", "source_db", "native_id", "kegg_id").agg(
        F.first("best.method").alias("bridge_method"), F.first("best.score").alias("bridge_score"), F.first("best.structure").alias("has_structure_evidence"),
        F.array_sort(F.collect_set("support")).alias("supporting_ids"), F.array_join(F.array_sort(F.collect_set("reason")), "; ").alias("bridge_reason"),
    ).withColumns({"bridge_confidence": bridge_confidence(F.col("bridge_score")), "arabidopsis_supported": F.col("source_db") == "AraCyc", "bridge_record_ids": F.array("record_id")})


def _row(frame: DataFrame, seq: Column, score: Column, method: Column | str, reason: Column, **more) -> DataFrame:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    rest = [lit(more.get(name, empty)).alias(name) for name, empty in _EVIDENCE.items()]
    return frame.select("compound_id", "kegg_id", seq.alias("seq"), score.cast("double").alias("score"), lit(method).alias("method"), reason.alias("reason"), *rest)


def name_hits(aliases: DataFrame, kegg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of each alias the KEGG compounds that its first hitting variant leads to, standard names before others; and the aliases that
    lead nowhere. kegg: kegg_id, primary_name, names."""
    standard = R.name_index(kegg.select("kegg_id", "primary_name"), "kegg_id", "primary_name").withColumn("is_alias", F.lit(False))
    others = kegg.select("kegg_id", "primary_name", F.explode("names").alias("n")).filter("n <> primary_name")
    other = R.name_index(others, "kegg_id", "n").withColumn("is_alias", F.lit(True))
    index = standard.unionByName(other).select("variant", "variant_rank", "key", "kegg_id", "is_alias")
    forms = F.array(*[F.struct(F.lit(v).alias("variant"), F.col(v).alias("key")) for v in T.VARIANTS])
    asked = aliases.withColumn("alias_id", F.concat_ws("|", "compound_id", "exact"))
    hits = asked.select("*", F.explode(forms).alias("f")).select(*asked.columns, "f.variant", "f.key").filter("key <> ''").join(index, ["variant", "key"])
    first = F.min(F.struct("variant_rank", "is_alias")).over(Window.partitionBy("alias_id"))
    hits = hits.withColumn("_first", first).filter("variant_rank = _first.variant_rank and is_alias = _first.is_alias")
    return hits, asked.join(hits.select("alias_id").distinct(), "alias_id", "left_anti")


def evidence(s: Standard, kegg: DataFrame, plant: DataFrame, keys: DataFrame) -> DataFrame:
    """All evidence for (compound_id, kegg_id) in order of arrival: references, structures, plant bridges, lipids and names."""
    known = kegg.select("kegg_id")
    compounds = s.compounds.select("compound_id", "chebi_accession")
    own = s.structures.select("compound_id", "formula_key", T.inchi_key(F.col("standard_inchi_key")).alias("key"))
    xref = s.xrefs.select("compound_id", F.explode("kegg_ids").alias("kegg_id")).join(known, "kegg_id").join(compounds, "compound_id")
    parts = [_row(xref, F.concat(F.lit("1/"), "kegg_id"), F.lit(XREF), "chebi_kegg_xref", F.concat(F.lit("Direct ChEBI KEGG cross-reference points to "), "kegg_id"), direct=True, external="ChEBI")]
    same = own.filter("key <> ''").join(keys.filter("kind = 'inchikey'"), "key").join(known, "kegg_id").join(compounds, "compound_id").withColumn("source", F.explode("sources"))
    said = F.concat(F.lit("Exact InChIKey match links "), "chebi_accession", F.lit(" to "), "kegg_id", F.lit(" via "), "source")
    parts.append(_row(same, F.concat(F.lit("2/"), "kegg_id", F.lit("/"), "source"), F.when(F.col("source") == "ChEBI", KEY_CHEBI).otherwise(KEY_OTHER), "inchi_key_exact", said, external=F.col("source"), structure=True))
    bridged = plant.join(known, "kegg_id")
    order = F.concat(F.lit("3/"), "kegg_id", F.format_string("/%.6f/", 1 - F.col("bridge_score")), "record_id")
    parts.append(
        _row(bridged, order, F.col("bridge_score"), F.col("bridge_method"), F.col("bridge_reason"), external=F.col("source_db"), structure=F.col("has_structure_evidence"), bridge_method=F.col("bridge_method"), bridge_source=F.col("source_db"), ara=F.col("arabidopsis_supported"))
    )
    lipid = s.matched_lipids.join(s.lipids.select("record_id", F.col("formula_key").alias("lipid_formula"), F.explode("kegg_ids").alias("kegg_id")), "record_id").join(known, "kegg_id").join(compounds, "compound_id").join(own.select("compound_id", "formula_key"), "compound_id", "left")
    has = lambda *kinds: reduce(lambda a, b: a | b, [F.array_contains("methods", k) for k in kinds])
    kind = F.when(has("inchi_key"), "structure").when(has("chebi", "kegg"), "crossref").when(has("pubchem"), "pubchem").otherwise("name")
    lipid = lipid.withColumn("kind", kind)
    score = F.create_map(*[x for k, v in LIPID.items() for x in (F.lit(k), F.lit(v))])[F.col("kind")]
    agree = (F.coalesce("formula_key", F.lit("")) != "") & (F.col("formula_key") == F.col("lipid_formula"))
    said = F.concat(F.lit("LIPID MAPS links "), "chebi_accession", F.lit(" to "), "kegg_id", F.lit(" via "), F.array_join("methods", ","))
    parts.append(_row(lipid, F.concat(F.lit("4/"), "record_id", F.lit("/"), "kegg_id"), F.when(agree, F.least(score + SAME_FORMULA, F.lit(NAME_MOST))).otherwise(score), F.concat(F.lit("lipidmaps_"), "kind"), said, external="LIPID MAPS", structure=F.col("kind") == "structure"))
    primary = kegg.select("kegg_id", "primary_name")
    aliases = s.aliases.select("compound_id", "raw_name", "source_type", "stage", "at", *T.VARIANTS).withColumn("place", F.concat_ws("/", F.lit("5"), "stage", "at", "exact"))
    hits, misses = name_hits(aliases, kegg)
    hits = hits.join(primary, "kegg_id")
    base = F.create_map(*[x for k, v in C.VARIANT_BASE_SCORES.items() for x in (F.lit(k), F.lit(v))])[F.col("variant")] + S.source_weight(F.col("source_type"))
    standard = F.concat("variant", F.lit(" standard-name match via "), "source_type", F.lit(": "), "raw_name")
    corrected = F.concat("variant", F.lit(" alias-table match via "), "source_type", F.lit(": "), "raw_name", F.lit("; corrected to standard name "), "primary_name")
    named = {"alias": F.col("raw_name"), "source_type": F.col("source_type"), "pubchem": F.col("source_type") == "pubchem_synonym"}
    parts.append(
        _row(hits, F.concat("place", F.lit("/"), "kegg_id"), F.least(F.when(F.col("is_alias"), base).otherwise(base + STANDARD_BONUS), F.lit(NAME_MOST)), F.concat(F.lit("name_match_"), "variant"), F.when(F.col("is_alias"), corrected).otherwise(standard), variant=F.col("variant"), primary=~F.col("is_alias"), **named)
    )
    parts.append(_fuzzy(misses, primary, own, formula_index(s), named))
    return reduce(DataFrame.unionByName, parts)


def formula_index(s: Standard) -> DataFrame:
    """compact and the set of formulas that any source gives a name."""
    return build.name_signatures(s).select(F.col("compact_name").alias("compact"), F.explode("formula_keys").alias("f")).groupBy("compact").agg(F.collect_set("f").alias("formulas"))


def _fuzzy(misses: DataFrame, primary: DataFrame, own: DataFrame, formulas: DataFrame, named: dict[str, Column]) -> DataFrame:
    """Aliases within two edits of a standard name, both without blanks and of six characters at least, whose formulas don't disagree."""
    theirs = primary.withColumn("primary_compact", T.variants(F.col("primary_name"))["compact"]).filter(F.length("primary_compact") >= 6)
    pairs = R.fuzzy_join(misses.filter(F.length("compact") >= 6).select("compact"), "compact", theirs.select("primary_compact"), "primary_compact")
    rows = misses.join(pairs, "compact").join(theirs, "primary_compact").join(own.select("compound_id", T.missing(F.col("formula_key")).alias("formula_key")), "compound_id", "left")
    rows = rows.join(formulas.withColumnRenamed("formulas", "of_name"), "compact", "left").join(formulas.withColumnsRenamed({"compact": "primary_compact", "formulas": "of_primary"}), "primary_compact", "left")
    none = F.array().cast("array<string>")
    left, right = F.when(F.col("formula_key").isNotNull(), F.array("formula_key")).otherwise(F.coalesce("of_name", none)), F.coalesce("of_primary", none)
    rows = rows.withColumns({"_l": left, "_r": right})
    shared = F.arrays_overlap("_l", "_r")
    rows = rows.filter((F.size("_l") == 0) | (F.size("_r") == 0) | shared)
    score = EDIT_BASE + S.source_weight(F.col("source_type")) + EDIT_BONUS + F.when((F.size("_l") > 0) & (F.size("_r") > 0), EDIT_BONUS).otherwise(0.0)
    said = F.concat(F.lit("compact edit<=2 with formula validation via "), "source_type", F.lit(": "), "raw_name", F.lit("; corrected to standard name "), "primary_name")
    return _row(rows, F.concat("place", F.lit("/"), "kegg_id"), F.least(score, F.lit(EDIT_MOST)), "name_match_compact_formula_edit2", said, variant="compact_formula_edit2", primary=True, **named)


def candidates(rows: DataFrame, kegg: DataFrame) -> DataFrame:
    """One row for each compound and KEGG compound: the evidence merged in its order, final_score and rank.

    Alias, source and variant are the last ones named by a piece that scored more than all before it.
    """
    keys = ["compound_id", "kegg_id"]
    before = Window.partitionBy(*keys).orderBy("seq", "method", "alias").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_up", F.col("score") > F.coalesce(F.max("score").over(before), F.lit(0.0)))
    last = lambda c: F.coalesce(F.max_by(c, F.when(F.col("_up") & (F.col(c) != ""), F.col("seq"))), F.lit(""))
    seen = rows.groupBy(*keys, "reason").agg(F.min("seq").alias("_s")).filter("reason <> ''")
    first = seen.groupBy(*keys).agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("_s", "reason"))), 1, 8), lambda x: x["reason"]).alias("reasons"))
    some = lambda c: F.array_sort(F.collect_set(T.missing(F.col(c))))
    found = rows.groupBy(*keys).agg(
        F.count("*").alias("evidence_count"), F.max("score").alias("best_score"), last("alias").alias("best_alias"), last("source_type").alias("best_source_type"), last("variant").alias("best_variant"), some("method").alias("methods"),
        some("external").alias("external_sources"), F.bool_or("direct").alias("direct_kegg_xref"), F.bool_or("primary").alias("primary_name_match"), F.bool_or("structure").alias("has_structure_evidence"),
        F.bool_or("pubchem").alias("used_pubchem_synonym"), some("bridge_method").alias("plant_bridge_methods"), some("bridge_source").alias("plant_bridge_sources"), F.bool_or("ara").alias("arabidopsis_supported"),
    )
    bonus = F.least(F.lit(0.05), 0.01 * (F.col("evidence_count") - 1)) + F.when(F.col("direct_kegg_xref"), 0.01).otherwise(0.0) + F.when(F.col("has_structure_evidence"), 0.01).otherwise(0.0)
    found = found.join(first, keys).join(kegg.select("kegg_id", F.col("primary_name").alias("kegg_primary_name")), "kegg_id").withColumn("final_score", F.least(F.col("best_score") + bonus, F.lit(0.999)))
    order = [F.desc("direct_kegg_xref"), F.desc("has_structure_evidence"), F.desc("best_score"), F.desc("primary_name_match"), F.desc("evidence_count"), F.desc("kegg_id")]
    return found.withColumn("candidate_rank", F.row_number().over(Window.partitionBy("compound_id").orderBy(*order)))


def selected(ranked: DataFrame) -> DataFrame:
    """All direct candidates of a compound; where it has none, the first one if it is sure: .88 at least, and alone, .96 or ahead by .03."""
    w = Window.partitionBy("compound_id")
    rows = ranked.withColumns({"_any": F.bool_or("direct_kegg_xref").over(w), "_n": F.count("*").over(w), "_next": F.lead("final_score").over(w.orderBy("candidate_rank"))})
    top = (F.col("candidate_rank") == 1) & (F.col("final_score") >= 0.88) & ((F.col("_n") == 1) | (F.col("final_score") >= 0.96) | (F.col("final_score") - F.col("_next") >= 0.03))
    return rows.filter((F.col("_any") & F.col("direct_kegg_xref")) | (~F.col("_any") & top)).drop("_any", "_n", "_next")


def mapping_confidence(score: Column) -> Column:
    return F.when(score >= 0.95, "high").when(score >= 0.88, "medium").otherwise("low")


def method_label() -> Column:
    has = lambda m: F.array_contains("methods", m)
    label = F.when(F.col("direct_kegg_xref"), "chebi_kegg_xref").when(has("inchi_key_exact"), "inchi_key_exact")
    for method in C.PLANT_BRIDGE_BASE_SCORES:
        label = label.when(has(method), method)
    label = label.when(F.col("has_structure_evidence") & F.array_contains("external_sources", "LIPID MAPS"), "lipidmaps_structure_crossref")
    label = label.when(F.arrays_overlap("external_sources", F.array(F.lit("AraCyc"), F.lit("PlantCyc"))), "plantcyc_crossref")
    return label.otherwise(F.concat(F.lit("name_match_"), F.coalesce(T.missing(F.col("best_variant")), F.lit("unknown"))))


def support_names(s: Standard) -> DataFrame:
    """compound_id, source_db, name_key and names of the pathways of matched records: a map of sets as a long table."""
    rows = s.matched_records.select("compound_id", "record_id").join(s.records.select("record_id", "source_db", F.explode("pathways").alias("n")), "record_id")
    return rows.withColumn("name_key", T.normalize_name(F.col("n"))).filter("name_key <> ''").groupBy("compound_id", "source_db", "name_key").agg(F.array_sort(F.collect_set("n")).alias("names"))


def pathways(chosen: DataFrame, links: DataFrame, ath: DataFrame, maps: DataFrame, categories: DataFrame, genes: DataFrame, support: DataFrame, reactome: DataFrame | None = None) -> DataFrame:
    """KEGG pathways of selected compounds, scored and ranked. links: kegg_id, map_pathway_id; ath: species pathways; categories:
    map_pathway_id, pathway_group, pathway_category; genes: pathway_id, gene_id; support: as ``support_names``."""
    of_map = links.groupBy("map_pathway_id").agg(F.count_distinct("kegg_id").alias("map_compounds"))
    of_ath = genes.groupBy(F.col("pathway_id").alias("ath_pathway_id")).agg(F.count_distinct("gene_id").alias("ath_genes"))
    most = of_map.agg(F.max("map_compounds").alias("most_compounds")).crossJoin(F.broadcast(of_ath.agg(F.max("ath_genes").alias("most_genes"))))
    rows = chosen.join(links, "kegg_id").join(ath.select("map_pathway_id", "ath_pathway_id", "ath_pathway_name"), "map_pathway_id", "left").join(maps, "map_pathway_id", "left").join(categories, "map_pathway_id", "left")
    rows = rows.join(of_map, "map_pathway_id").join(of_ath, "ath_pathway_id", "left").crossJoin(F.broadcast(most)).fillna(0, ["ath_genes"]).fillna("", ["pathway_group", "pathway_category"])
    rows = rows.withColumn("pathway_name", F.coalesce("ath_pathway_name", "map_pathway_name", "map_pathway_id")).withColumn("name_key", T.normalize_name(F.col("pathway_name")))
    for source in ("AraCyc", "PlantCyc"):
        rows = rows.join(support.filter(F.col("source_db") == source).select("compound_id", "name_key", F.col("names").alias(source)), ["compound_id", "name_key"], "left")
    here = F.col("ath_pathway_id").isNotNull()
    rows = rows.withColumns(
        {
            "pathway_target_id": F.coalesce("ath_pathway_id", "map_pathway_id"),
            "pathway_target_type": F.when(here, "ath").otherwise("map_fallback"),
            "plantcyc_support_source": F.when(F.col("AraCyc").isNotNull(), "AraCyc").when(F.col("PlantCyc").isNotNull(), "PlantCyc").otherwise(""),
            "plantcyc_support_examples": F.coalesce(F.array_join(F.slice(F.coalesce("AraCyc", "PlantCyc"), 1, 3), ";"), F.lit("")),
        }
    ).drop("AraCyc", "PlantCyc")
    on = lambda c, v: F.when(c, F.lit(v)).otherwise(0.0)
    generic = F.col("map_pathway_id").isin(*C.GENERIC_KEGG_MAPS) | (F.col("pathway_category") == GLOBAL_MAPS)
    plant = F.when(F.col("plantcyc_support_source") == "AraCyc", PATHWAY["aracyc"]).when(F.col("plantcyc_support_source") == "PlantCyc", PATHWAY["plantcyc"]).otherwise(0.0)
    parts = {
        "mapping_confidence": exact_round(PATHWAY["mapping"] * F.col("final_score"), 3),
        "pathway_specificity": exact_round(PATHWAY["specificity"] * (1 - F.log1p("map_compounds") / F.log1p("most_compounds")), 3),
        "ath_exists": on(here, PATHWAY["ath"]),
        "ath_gene_support": F.when(F.col("ath_genes") > 0, exact_round(PATHWAY["genes"] * F.log1p("ath_genes") / F.log1p("most_genes"), 3)).otherwise(0.0),
        "direct_kegg_xref": on(F.col("direct_kegg_xref"), PATHWAY["xref"]),
        "structure_support": on(F.col("has_structure_evidence"), PATHWAY["structure"]),
        "plantcyc_support": plant,
        "generic_pathway_penalty": on(generic, PATHWAY["generic"]),
        "map_fallback_penalty": on(~here, PATHWAY["fallback"]),
    }
    rows = rows.withColumn("contributions", F.struct(*[c.alias(n) for n, c in parts.items()]))
    rows = rows.withColumn("score", R.clamp(reduce(lambda a, b: a + b, [F.col(f"contributions.{n}") for n in parts])))
    rows = rows.withColumn("confidence_level", F.when((F.col("score") >= 0.70) & here & (F.col("ath_genes") > 0), "high").when(F.col("score") >= 0.40, "medium").otherwise("low"))
    entries = F.array(*[F.struct(F.col(f"contributions.{n}").alias("v"), F.lit(i).alias("i"), F.lit(n).alias("k")) for i, n in enumerate(parts)])
    label = lambda es, n: F.array_join(F.transform(F.slice(es, 1, n), lambda e: F.concat(e["k"], F.lit("="), F.format_string("%.3f", e["v"]))), ";")
    up = F.array_sort(F.transform(F.filter(entries, lambda e: e["v"] > 0), lambda e: F.struct((-e["v"]).alias("s"), e["i"].alias("i"), e["v"].alias("v"), e["k"].alias("k"))))
    down = F.array_sort(F.filter(entries, lambda e: e["v"] < 0))
    by_name = F.array_join(F.array(*[F.concat(F.lit(f'"{n}": '), build.short_number(F.col(f"contributions.{n}"))) for n in sorted(parts)]), ", ")
    rows = rows.withColumns({"top_positive_features": label(up, 3), "top_negative_features": label(down, 2), "feature_contributions_json": F.concat(F.lit("{"), by_name, F.lit("}"))})
    why = [
        F.concat("confidence_level", F.lit(" confidence pathway for "), "kegg_id", F.lit(" -> "), "pathway_name"), F.concat(F.lit("score "), F.format_string("%.3f", exact_round(F.col("score"), 3))),
        F.concat(F.lit("mapping reason: "), F.array_join(F.slice("reasons", 1, 4), "; ")), F.when(~here, "used map fallback because no ath-specific pathway was available"),
        F.when(F.col("ath_genes") > 0, F.concat(F.lit("ath gene support: "), F.col("ath_genes").cast("string"))),
        F.when(F.col("plantcyc_support_source") != "", F.concat("plantcyc_support_source", F.lit(" support: "), "plantcyc_support_examples")),
        F.when(F.col("top_positive_features") != "", F.concat(F.lit("top positive features: "), "top_positive_features")), F.when(F.col("top_negative_features") != "", F.concat(F.lit("top negative features: "), "top_negative_features")),
    ]
    rows = rows.withColumn("reason", F.concat_ws("; ", *why))
    if reactome is not None:
        w = Window.partitionBy("name_key").orderBy("_seq")
        few = reactome.withColumn("_n", F.row_number().over(w)).filter("_n <= 3").groupBy("name_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", F.concat_ws("|", "reactome_id", "species").alias("t")))), lambda x: x["t"]), ";").alias("reactome_matches"))
        rows = rows.join(few, "name_key", "left").fillna("", ["reactome_matches"])
    names = rows.groupBy("compound_id", "pathway_target_id").agg(F.array_sort(F.collect_set("kegg_id")).alias("support_kegg_ids"), F.array_sort(F.collect_set("kegg_primary_name")).alias("support_kegg_names"))
    best = S.best_per_group(rows, ["compound_id", "pathway_target_id"], [F.desc("score"), F.asc("candidate_rank"), F.asc("map_pathway_id")]).join(names, ["compound_id", "pathway_target_id"])
    order = [F.desc("score"), F.desc("ath_genes"), F.asc("map_compounds"), F.desc("pathway_target_id")]
    return best.withColumn("pathway_rank", F.row_number().over(Window.partitionBy("compound_id").orderBy(*order))).drop("contributions", "name_key")


NAME_COLUMNS = [
    "compound_id", "chebi_accession", "canonical_name", "canonical_exact_name", "canonical_compact_name", "canonical_singular_name", "canonical_stereo_stripped_name", "kegg_compound_id", "kegg_primary_name", "mapping_score",
    "mapping_confidence_level", "mapping_method", "direct_kegg_xref", "has_structure_evidence", "used_pubchem_synonym", "best_alias", "best_alias_source", "best_variant", "evidence_count", "external_sources", "bridge_method",
    "bridge_confidence", "bridge_source_db", "arabidopsis_supported", "mapping_reason",
]
STRUCTURE_COLUMNS = ["kegg_cid", "inchi_key_full", "smiles_norm", "source_dbs", "source_count"]
BRIDGE_COLUMNS = [
    "compound_id", "chebi_accession", "canonical_name", "plant_db", "plant_compound_id", "kegg_cid", "kegg_primary_name", "bridge_method", "bridge_score", "bridge_confidence", "bridge_record_ids", "supporting_ids",
    "arabidopsis_supported", "has_structure_evidence", "bridge_reason",
]
RECORD_COLUMNS = [
    "plant_db", "plant_compound_id", "canonical_name", "name_norm_exact", "name_norm_compact", "name_norm_singular", "synonym_list", "formula", "formula_key", "smiles_raw", "smiles_norm", "inchi_key_full", "chebi_ids",
    "pubchem_cids", "kegg_ids", "hmdb_ids", "pathway_count", "pathway_examples", "arabidopsis_supported",
]


def write(s: Standard, chosen: DataFrame, keys: DataFrame, plant: DataFrame, kegg: DataFrame, paths: Paths) -> None:
    """The tables of names, structures, records and bridges that lead to KEGG."""
    named = s.compounds.select("compound_id", "chebi_accession", F.col("name").alias("canonical_name"))
    v = named.withColumn("v", T.variants(F.col("canonical_name"))).select(*named.columns, *[F.col(f"v.{x}").alias(f"canonical_{x}_name") for x in T.VARIANTS])
    bridged = F.size("plant_bridge_methods") > 0
    rows = chosen.join(v, "compound_id").withColumnsRenamed({"kegg_id": "kegg_compound_id", "best_source_type": "best_alias_source"}).withColumns(
        {
            "mapping_score": F.col("final_score"), "mapping_confidence_level": mapping_confidence(F.col("final_score")), "mapping_method": method_label(),
            "bridge_method": F.coalesce(F.get("plant_bridge_methods", F.lit(0)), F.lit("")), "bridge_confidence": F.when(bridged, mapping_confidence(F.col("final_score"))).otherwise(""),
            "bridge_source_db": F.coalesce(F.get("plant_bridge_sources", F.lit(0)), F.lit("")), "mapping_reason": F.array_join(F.slice("reasons", 1, 4), "; "),
        }
    )
    three = {"mapping_score": ".3f"}
    W.write_tsv(rows, paths.index("name_to_kegg_index.tsv"), NAME_COLUMNS, build._by_id(F.asc("candidate_rank")), three)
    flat = keys.select(F.col("kegg_id").alias("kegg_cid"), F.when(F.col("kind") == "inchikey", F.col("key")).otherwise("").alias("inchi_key_full"), F.when(F.col("kind") == "smiles", F.col("key")).otherwise("").alias("smiles_norm"), F.col("sources").alias("source_dbs"), F.size("sources").alias("source_count"))
    W.write_tsv(flat, paths.index("kegg_structure_index.tsv"), STRUCTURE_COLUMNS, [F.asc(c) for c in STRUCTURE_COLUMNS[:3]])
    w = s.records.withColumn("v", T.variants(F.col("common_name")))
    records = w.withColumns({"plant_db": F.col("source_db"), "plant_compound_id": F.col("native_id"), "canonical_name": F.col("common_name"), "synonym_list": F.col("synonyms"), "smiles_raw": F.col("smiles"), "smiles_norm": F.trim("smiles"), "inchi_key_full": F.col("inchi_key"), "pathway_count": F.size("pathways"), "pathway_examples": F.slice("pathways", 1, 3), "arabidopsis_supported": F.col("source_db") == "AraCyc", **{f"name_norm_{x}": F.col(f"v.{x}") for x in T.VARIANTS[:3]}})
    W.write_tsv(records, paths.index("plantcyc_compound_index.tsv"), RECORD_COLUMNS, [F.asc("record_id")])
    out = plant.join(named, "compound_id").join(kegg.select("kegg_id", F.col("primary_name").alias("kegg_primary_name")), "kegg_id", "left").withColumnsRenamed({"kegg_id": "kegg_cid", "source_db": "plant_db", "native_id": "plant_compound_id"})
    W.write_tsv(out, paths.index("plant_to_kegg_bridge.tsv"), BRIDGE_COLUMNS, build._by_id(F.asc("kegg_cid"), F.desc("bridge_score")), {"bridge_score": ".3f"})


def run(spark: SparkSession, paths: Paths, s: Standard) -> DataFrame:
    """From standardised compounds to ranked KEGG pathways, with the tables on the way."""
    kegg = K.kegg_compounds(spark, paths.ref("kegg_compound_list.tsv"))
    keys = structure_keys(s)
    plant = bridges(s, keys)
    ranked = candidates(evidence(s, kegg, plant, keys), kegg)
    where = paths.index("stages/kegg_candidates")
    ranked.write.mode("overwrite").parquet(where)
    chosen = selected(spark.read.parquet(where))
    write(s, chosen, keys, plant, kegg, paths)
    tree = readers.hierarchy(spark, paths.ref("kegg_pathway_hierarchy.txt")).select(F.concat(F.lit("map"), "pathway_id").alias("map_pathway_id"), F.col("group").alias("pathway_group"), F.col("category").alias("pathway_category"))
    ath = K.species_pathways(spark, paths.ref("kegg_pathway_ath.tsv"))
    genes = K.pathway_genes(spark, paths.ref("kegg_ath_gene_pathway.tsv"))
    links = K.compound_links(spark, paths.ref("kegg_compound_pathway.tsv"))
    return pathways(chosen, links, ath, K.map_pathways(spark, paths.ref("kegg_pathway_map.tsv")), tree, genes, support_names(s), K.reactome_names(spark, paths.ref("ReactomePathways.txt")))
