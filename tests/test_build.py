"""The batch build over a small work folder, against values worked out by hand."""

import json
import math
from pathlib import Path

import pytest

from siftwell.plans import build
from siftwell.sources.paths import Paths, latest

from fixture import read_tsv


def table(built, name):
    return read_tsv(built[0].index(name))


def test_newest_file_and_missing_files(spark, built, tmp_path):
    assert latest(spark, built[0].refs, "aracyc_compounds", "x").endswith("aracyc_compounds.20240101")
    assert latest(spark, built[0].refs, "absent", "x") == f"{built[0].refs}/x"
    with pytest.raises(FileNotFoundError):
        Paths(str(tmp_path)).check(spark)


def test_aliases(built):
    rows = read_tsv(f"{built[0].workdir}/outputs/chebi_aliases_standardized.tsv")
    assert list(rows[0]) == build.ALIAS_COLUMNS
    own = {r["normalized_name"]: (r["alias"], r["source_type"]) for r in rows if r["compound_id"] == "1"}
    # The synonym outweighs the systematic name; the cleaned record's synonym is lighter than both.
    assert own["dextrose"] == ("dextrose", "chebi_synonym")
    assert own["d glucose"] == ("D-glucose", "compound_name")
    assert own["glucose record"] == ("glucose record", "aracyc_common_name")
    assert own["grape sugar"] == ("grape sugar", "aracyc_synonym")
    assert own["sweet lipid"] == ("sweet lipid", "lipidmaps_common_name")
    assert own["sweet"] == ("sweet", "lipidmaps_synonym")
    assert own["corn sugar"] == ("corn sugar", "pubchem_synonym")
    assert own["sweet thing"] == ("sweet thing", "pubchem_synonym")
    assert not {"traubenzucker", "glucosol", "abc123456", "chebi 4167"} & set(own)
    three = {r["normalized_name"]: r["alias"] for r in rows if r["compound_id"] == "3"}
    # The primary name's variants keep its raw form; the ASCII name has the same exact form and less weight.
    assert three["beta things"] == "β-thing's"
    two = {r["normalized_name"]: r["alias"] for r in rows if r["compound_id"] == "2"}
    assert two["bornan 2 one"] == "bornan 2-one"
    # Six records share the name, so none of them lends it anything.
    assert {r["source_type"] for r in rows if r["compound_id"] == "8"} == {"compound_name"}


def test_entities(built):
    rows = table(built, "step1_result.tsv")
    assert list(rows[0]) == build.ENTITY_COLUMNS
    by_id = {r["compound_id"]: r for r in rows if r["compound_id"]}
    assert (by_id["1"]["aracyc_compound_id"], by_id["1"]["resolved_by"]) == ("GLC", "inchikey")
    assert (by_id["1"]["formula"], by_id["1"]["formula_key"], by_id["1"]["smiles"]) == ("C6 H12 O6", "C6H12O6", "OCC")
    assert (by_id["1"]["kegg_ids"], by_id["1"]["pubchem_cids"], by_id["1"]["hmdb_ids"]) == ("C00031", "42;5793", "HMDB:0001")
    assert (by_id["1"]["pathways"], by_id["1"]["pathway_count"]) == ("Glucose degradation I;sugar biosynthesis", "2")
    # Of two records the one with a pathway; of two KEGG ids the first that leads anywhere.
    assert (by_id["2"]["aracyc_compound_id"], by_id["2"]["resolved_by"]) == ("CAMPHOR", "chebi_xref")
    assert (by_id["3"]["aracyc_compound_id"], by_id["3"]["resolved_by"]) == ("BETA", "kegg_xref")
    native = {r["aracyc_compound_id"]: r for r in rows if not r["compound_id"]}
    assert {"LONE", "GAMMA", "BERRY", "SHAPE"} <= set(native)
    assert not {"GLC", "CAMPHOR", "CAMPHOR2", "BETA"} & set(native)
    assert (native["LONE"]["chebi_accession"], native["LONE"]["ascii_name"], native["LONE"]["alias_count"]) == ("CHEBI:77", "Lone «e» record", "3")
    assert [r["entity_source"] for r in rows] == ["chebi"] * 8 + ["aracyc"] * (len(rows) - 8)
    aliases = table(built, "step1_alias_unified.tsv")
    assert {r["alias"] for r in aliases if r["aracyc_compound_id"] == "LONE"} == {"Lone «é» record", "alone", "solo"}


def test_matches(built):
    rows = {r["compound_id"]: r for r in table(built, "name_to_aracyc_index.tsv")}
    got = {i: (r["aracyc_compound_id"], r["source_db"], r["match_method"], r["match_score"], r["chebi_xref_direct"], r["structure_validated"]) for i, r in rows.items()}
    assert got == {
        "1": ("GLC", "AraCyc", "inchikey", "1.0000", "false", "true"),
        "2": ("CAMPHOR", "AraCyc", "chebi_xref", "0.9800", "true", "false"),
        "3": ("BETA", "AraCyc", "kegg_xref", "0.9500", "false", "false"),
        "4": ("BERRY", "AraCyc", "name_singular", "0.7300", "false", "false"),
        "5": ("PT", "PlantCyc", "chebi_xref", "0.8500", "true", "false"),
        "7": ("SHAPE", "AraCyc", "tanimoto", "0.8500", "false", "true"),
        "8": ("COMMON0", "AraCyc", "name_exact", "0.8000", "false", "false"),
    }
    audit = table(built, "aracyc_match_candidates.tsv")
    six = [r for r in audit if r["compound_id"] == "6"]
    assert [(r["selection_status"], r["candidate_count"], r["candidate_rank"], r["pathway_count"], r["chebi_xref_direct"]) for r in six] == [("no_match", "0", "", "0", "false")]
    five = [(r["aracyc_compound_id"], r["candidate_rank"], r["match_method"], r["match_score"], r["is_selected"]) for r in audit if r["compound_id"] == "5"]
    assert five == [("PT", "1", "chebi_xref", "0.8500", "true"), ("PT2", "2", "chebi_xref", "0.8500", "false")]
    assert len([r for r in audit if r["compound_id"] == "8"]) == 6
    assert next(r["reference_compound_key"] for r in audit if r["aracyc_compound_id"] == "BERRY") == "name:fancy berry"


def test_links(built):
    rows = {(r["compound_id"], r["pathway_name"]): r for r in table(built, "aracyc_raw_pathway_hits.tsv")}
    one = rows["1", "sugar biosynthesis"]
    assert (one["pathway_id"], one["ec_numbers"], one["reaction_ids"], one["reaction_equations"]) == ("PWY-1", "EC-1.1.1.1;EC-2.7.1.2;EC-9.9.9.9", "R1;R2", "a -> b ; b -> c")
    assert rows["7", "Sugar Biosynthesis!"]["pathway_id"] == "PWY-1"
    assert rows["3", "unlisted pathway"]["pathway_id"] == ""
    assert rows["5", "plant pathway"]["pathway_id"] == "PLANT-2"
    assert [r["hit_rank"] for k, r in rows.items() if k[0] == "1"] == ["1", "2"]


def test_annotations_and_scores(built):
    rows = {(r["compound_id"], r["pathway_name"]): r for r in table(built, "aracyc_pathway_annotation_index.tsv")}
    one = rows["1", "sugar biosynthesis"]
    assert (one["pathway_category"], one["gene_count"], one["gene_ids"], one["reaction_count"], one["compound_count"]) == ("Biosynthesis", "3", "AT1G00001;AT1G00002;AT1G00003", "2", "4")
    # Three of three genes carry the process, of ten in the background, seven of which it lacks.
    assert (one["go_best_term"], one["go_best_fdr"]) == ("sweet process", f"{1 / math.comb(10, 3):.6f}")
    assert (one["plant_reactome_best_name"], one["plant_reactome_alignment_confidence"], one["annotation_confidence"]) == ("Sugar biosynthesis pathway", "high", "high")
    # The genes of the second pathway are too few for processes.
    assert (rows["1", "Glucose degradation I"]["go_best_term"], rows["1", "Glucose degradation I"]["gene_count"]) == ("", "2")
    # "camphor" holds "amp".
    assert rows["2", "camphor degradation"]["cofactor_like"] == "true"
    out = read_tsv(f"{built[0].tables}/chebi_pathways_aracyc_refactored.tsv")
    assert list(out[0]) == build.OUTPUT_COLUMNS
    first = next(r for r in out if (r["compound_id"], r["pathway_rank"]) == ("1", "1"))
    genes, specific = 0.12 * math.log1p(3) / math.log1p(3), 0.10 * (1 - math.log1p(4) / math.log1p(4))
    parts = {
        "match_confidence": 0.3, "chebi_xref_direct": 0.0, "structure_validated": 0.08, "gene_support": round(genes, 4), "pathway_specificity": round(specific, 4), "ec_support": 0.06, "reaction_present": 0.04,
        "multi_reaction_bonus": round(0.02 * math.log1p(2), 4), "cofactor_penalty": 0.0, "plantcyc_corroboration": 0.05, "plant_reactome_alignment": 0.03, "go_enrichment_bonus": 0.02, "annotation_quality": 0.03,
    }
    assert first["feature_contributions_json"].replace('""', '"').strip('"') in (json.dumps(parts), json.dumps(parts).strip('"'))
    assert first["score"] == f"{sum(parts.values()):.4f}"
    assert first["confidence_level"] == "high"
    assert first["top_positive_features"] == "match_confidence(+0.300), gene_support(+0.120), structure_validated(+0.080)"
    assert first["reason"] == f"AraCyc match: GLC (inchikey, score=1.00); pathway=sugar biosynthesis; category=Biosynthesis; genes=3; EC=EC-1.1.1.1;EC-2.7.1.2;EC-9.9.9.9; final_score={sum(parts.values()):.3f} (high)"
    assert first["go_best_fdr"] == f"{1 / math.comb(10, 3):.6g}"
    assert next(r for r in out if r["compound_id"] == "5")["evidence_type"] == "plantcyc_fallback"
    ids = [int(r["compound_id"]) for r in out]
    assert ids == sorted(ids)


def test_name_signatures_and_metadata(built):
    rows = {r["exact_name"]: r for r in table(built, "name_to_formula_index.tsv")}
    assert (rows["dextrose"]["formula_keys"], rows["dextrose"]["evidence_sources"], rows["dextrose"]["inchi_key_prefixes"]) == ("C6H12O6", "AraCyc;ChEBI", "AAAAAAAAAAAAAA")
    meta = built[1]
    assert (meta["chebi_input_total"], meta["aracyc_mapping_status"], meta["preprocess_counts"]["step1_resolved_inchikey"]) == (8, {"matched_aracyc": 6, "matched_plantcyc": 1, "no_match": 1}, 1)
    parts = sorted(Path(f"{built[0].workdir}/outputs/summary.json").glob("part-*"))
    assert json.loads("".join(p.read_text() for p in parts))["comments_profile"] == {"a": 2, "<empty>": 1}
