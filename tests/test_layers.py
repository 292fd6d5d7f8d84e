"""Alignment, Plant Reactome companions, KEGG mapping and learned recall, against plain Python and values worked out by hand."""

import json
import math
import re
import unicodedata
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.plans import align, build, kegg, recall
from siftwell.sources import catalog, reactome

from fixture import read_tsv


def fold(text):
    return re.sub(r"[^a-z0-9]+", " ", unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()).strip()


def test_alignment_is_plain_pythons(spark):
    rng = np.random.default_rng(1)
    words = ["sugar", "acid", "cycle", "β-oxidation", "beta", "synthesis", "I", "II", "é"]
    name = lambda: " ".join(rng.choice(words, rng.integers(1, 4)))
    ath, ara = [(f"a{k}", name()) for k in range(6)], [(f"p{k:02}", name()) for k in range(30)]
    pick = lambda ids, n: [(i, f"m{m}") for i, _ in ids for m in rng.choice(12, rng.integers(0, n), replace=False)]
    sets = [pick(ath, 5), pick(ara, 6), pick(ath, 3), pick(ara, 3)]
    frame = lambda rows, key: spark.createDataFrame(rows, f"{key}_pathway_id string, member string")
    got = align.align(
        spark.createDataFrame(ath, "ath_pathway_id string, ath_pathway_name string"), spark.createDataFrame(ara, "aracyc_pathway_id string, aracyc_pathway_name string"),
        frame(sets[0], "ath"), frame(sets[1], "aracyc"), frame(sets[2], "ath"), frame(sets[3], "aracyc"), 4,
    ).collect()
    of = lambda rows, i: {m for j, m in rows if j == i}
    want = {}
    for a, an in ath:
        scored = []
        for p, pn in ara:
            exact, like = int(fold(an) == fold(pn)), SequenceMatcher(None, fold(an), fold(pn)).ratio() if fold(an) and fold(pn) else 0.0
            score, n = 6.0 * exact + 2.0 * like, []
            for x, y in ((of(sets[0], a), of(sets[1], p)), (of(sets[2], a), of(sets[3], p))):
                n.append(len(x & y))
                score += 4.0 * (len(x & y) / len(x | y) if x | y else 0) + 3.0 * (len(x & y) / min(len(x), len(y)) if x and y else 0)
            score += 1.0 * (n[0] > 0 and n[1] > 0)
            level = "high" if exact or score >= 6 and n[0] else "medium" if score >= 4 and (n[0] or n[1]) else "low"
            scored.append((round(score, 9), exact, n[0], n[1], round(like, 9), -len(of(sets[1], p)), p, level))
        want[a] = sorted(scored, reverse=True)[:4]
    for a in want:
        mine = sorted((r for r in got if r.ath_pathway_id == a), key=lambda r: r.rank)
        assert [(round(r.alignment_score, 9), r.name_exact, r.shared_gene_count, r.shared_compound_count, round(r.name_similarity, 9), -r.aracyc_gene_count, r.aracyc_pathway_id, r.alignment_confidence) for r in mine] == want[a]


def test_alignment_of_a_work_folder(spark, built):
    found = align.run(spark, built[0])
    rows = read_tsv(built[0].index("kegg_ath_to_aracyc_pathway_best.tsv"))
    assert list(rows[0]) == align.COLUMNS
    one = next(r for r in rows if r["ath_pathway_id"] == "ath00010")
    like = SequenceMatcher(None, "sugar biosynthesis", "glucose degradation i").ratio()
    # One of two genes, and the one compound that both have.
    assert (one["aracyc_pathway_id"], one["shared_gene_count"], one["shared_compound_count"]) == ("PWY-2", "1", "1")
    assert one["alignment_score"] == f"{2 * like + 4 * 0.5 + 3 + 4 + 3 + 1:.6f}"
    second = found.filter("ath_pathway_id = 'ath00010' and rank = 2").first()
    # Named by the last row with a name; both genes and one of its four compounds.
    assert (second.aracyc_pathway_name, second.shared_gene_count, second.compound_jaccard) == ("other name", 2, 0.25)
    assert (one["alignment_confidence"], one["rank"]) == ("high", "1")
    assert align.summary(found).first().n_pathways == 2


def test_companions(spark):
    pathways = spark.createDataFrame([("P1", "Sugar synthesis", "Metabolism", "Lipid metabolism", ""), ("P2", "No match", "", "", "")], "pathway_id string, pathway_name string, brite_l1 string, brite_l2 string, brite_l3 string")
    genes = spark.createDataFrame([("P1", g) for g in "ABCD"] + [("P2", "Z")], "pathway_id string, gene_id string")
    other = spark.createDataFrame([("R1", "sugar-synthesis", "Oryza", "", "", "", ""), ("R2", "Sugarsynthesis", "Arabidopsis thaliana", "", "", "", ""), ("R3", "Far name", "Arabidopsis thaliana", "", "", "", ""), ("R4", "Lone", "x", "", "", "", "")], "pathway_id string, pathway_name string, species string, top_level_category string, description string, name_normalized string, name_compact string")
    theirs = spark.createDataFrame([("R3", "A"), ("R3", "B"), ("R3", "C"), *[("R4", f"G{k}") for k in range(30)], ("R4", "A")], "pathway_id string, gene_id string")
    got = {r.plant_reactome_id: r for r in align.companions(pathways, genes, other, theirs).collect()}
    assert set(got) == {"R1", "R2", "R3"}
    assert (got["R1"].alignment_score, got["R1"].name_similarity) == (0.15, 1.0)
    assert (got["R2"].alignment_score, got["R2"].name_similarity) == (round(0.15 * 0.97 + 0.1, 4), 0.97)
    assert (got["R3"].alignment_score, got["R3"].gene_overlap_count, got["R3"].alignment_confidence, got["R3"].rank) == (round(0.5 * 0.75 + 0.2 * 0.75 + 0.1, 4), 3, "high", 1)


def test_reactome_snapshot(spark, tmp_path):
    tree = [{"stId": "T1", "name": "Top", "type": "TopLevelPathway", "species": "S", "children": [{"stId": "P1", "displayName": "Inner", "type": "Pathway", "children": [{"stId": "X", "name": "step", "type": "Reaction"}, {"stId": "P2", "name": "Deep", "type": "Pathway"}]}]}]
    hierarchy = spark.createDataFrame([(json.dumps(tree),)], "value string")
    details = spark.createDataFrame([("P1", json.dumps({"displayName": "Inner <i>β</i>", "releaseDate": "2025-02-15", "goBiologicalProcess": {"accession": "1", "displayName": "go"}, "summation": [{"text": "about <b>it</b>"}]}))], "pathway_id string, value string")
    people = spark.createDataFrame([("P1", json.dumps([{"refEntities": [{"identifier": "at1g01010.1"}, {"other": "AT9G99999", "identifier": 5}]}, {"identifier": "x AT2G02020"}]))], "pathway_id string, value string")
    rows, genes = reactome.snapshot(hierarchy, details, people)
    got = {r.pathway_id: r for r in rows.collect()}
    assert {k: (r.pathway_name, r.top_level_category, r.species) for k, r in got.items()} == {"T1": ("Top", "Top", "S"), "P1": ("Inner <i>β</i>", "Top", ""), "P2": ("Deep", "Top", "")}
    assert (got["P1"].name_normalized, got["P1"].go_biological_process_id, got["P1"].description.split()) == ("inner beta", "1", ["about", "it"])
    assert sorted(tuple(r) for r in genes.collect()) == [("P1", "AT1G01010"), ("P1", "AT2G02020")]
    reactome.write(rows, genes, str(tmp_path))
    assert [r["pathway_id"] for r in read_tsv(f"{tmp_path}/plant_reactome_pathways.tsv")] == ["P1", "P2", "T1"]


@pytest.fixture(scope="module")
def mapped(spark, built):
    s = build.load(spark, built[0])
    ranked = kegg.run(spark, built[0], s).cache()
    return s, build.stage(spark, built[0], "kegg_candidates"), ranked


def test_kegg_candidates(mapped, built):
    rows = {(r.compound_id, r.kegg_id): r for r in mapped[1].collect()}
    one = rows["1", "C00031"]
    # A reference, the structure's key, and names: D-glucose, dextrose and grape sugar; one bridge, by the record's accession.
    assert (one.direct_kegg_xref, one.has_structure_evidence, one.best_score) == (True, True, 0.995)
    assert set(one.methods) == {"chebi_kegg_xref", "inchi_key_exact", "plant_via_chebi", "name_match_exact"}
    assert one.final_score == 0.999
    assert one.reasons[0] == "Direct ChEBI KEGG cross-reference points to C00031"
    assert len(one.reasons) <= 8
    # "fancy berries" meets the standard name "Fancy berry" in its singular.
    four = rows["4", "C00099"]
    assert (four.best_variant, four.best_alias, four.primary_name_match, four.evidence_count) == ("singular", "fancy berries", True, 1)
    assert four.best_score == pytest.approx(0.79 + 0.10 + 0.03)
    assert ("3", "C00009") in rows
    assert {"chebi_kegg_xref", "plant_direct_kegg_xref"} <= set(rows["3", "C00009"].methods)


def test_kegg_selection(mapped, built):
    rows = {(r["compound_id"], r["kegg_compound_id"]): r for r in read_tsv(built[0].index("name_to_kegg_index.tsv"))}
    assert rows["1", "C00031"]["mapping_method"] == "chebi_kegg_xref"
    assert (rows["1", "C00031"]["mapping_score"], rows["1", "C00031"]["mapping_confidence_level"]) == ("0.999", "high")
    assert rows["4", "C00099"]["mapping_method"] == "name_match_singular"
    assert (rows["4", "C00099"]["mapping_score"], rows["4", "C00099"]["bridge_method"]) == ("0.920", "")
    bridge = read_tsv(built[0].index("plant_to_kegg_bridge.tsv"))
    one = next(r for r in bridge if r["compound_id"] == "1")
    # By its accession: 0.930, and 0.01 for its PubChem id; the key's 0.920 with two supports is as much, but came later.
    assert (one["kegg_cid"], one["bridge_method"], one["bridge_score"], one["supporting_ids"]) == ("C00031", "plant_via_chebi", "0.940", "CHEBI:1;InChIKey:AAAAAAAAAAAAAA-BBBBBBBBBB-N;PUBCHEM:5793;SMILES:OCC")
    assert len(read_tsv(built[0].index("plantcyc_compound_index.tsv"))) == 16


def test_kegg_pathways(mapped):
    got = {(r.compound_id, r.pathway_target_id): r for r in mapped[2].collect()}
    one = got["1", "ath00010"]
    # One compound is on the map; the most any map has is one.
    parts = {"mapping_confidence": round(0.45 * 0.999, 3), "ath_exists": 0.12, "ath_gene_support": 0.1, "direct_kegg_xref": 0.05, "structure_support": 0.05, "plantcyc_support": 0.06}
    assert one.score == pytest.approx(sum(parts.values()))
    assert (one.confidence_level, one.plantcyc_support_source, one.plantcyc_support_examples, one.pathway_category) == ("high", "AraCyc", "sugar biosynthesis", "Carbohydrate metabolism")
    assert one.reactome_matches == "R-HSA-1|Homo sapiens;R-ATH-1|Arabidopsis thaliana"
    assert json.loads(one.feature_contributions_json)["ath_exists"] == 0.12
    assert one.top_positive_features == "mapping_confidence=0.450;ath_exists=0.120;ath_gene_support=0.100"
    whole = got["1", "map01100"]
    assert (whole.pathway_target_type, whole.confidence_level) == ("map_fallback", "low")
    assert whole.top_negative_features == "map_fallback_penalty=-0.100;generic_pathway_penalty=-0.060"
    assert [got["1", t].pathway_rank for t in ("ath00010", "map01100")] == [1, 2]


def test_selection_rules(spark):
    rows = [("a", "1", 1, 0.90, False), ("a", "2", 2, 0.88, False), ("b", "1", 1, 0.97, False), ("b", "2", 2, 0.96, False), ("c", "1", 1, 0.9, True), ("c", "2", 2, 0.99, False), ("d", "1", 1, 0.87, False), ("e", "1", 1, 0.88, False), ("f", "1", 1, 0.95, False), ("f", "2", 2, 0.92, False)]
    frame = spark.createDataFrame(rows, "compound_id string, kegg_id string, candidate_rank int, final_score double, direct_kegg_xref boolean")
    got = {(r.compound_id, r.kegg_id) for r in kegg.selected(frame).collect()}
    assert {k[0] for k in got} - {"f"} == {"b", "c", "e"}
    assert (("f", "1") in got) == (0.95 - 0.92 >= 0.03)


def test_recall_features(spark, built):
    s = build.load(spark, built[0])
    rows = {r.compound_id: r for r in recall.compound_features(s).collect()}
    one = rows["1"]
    assert (one.mass, one.elem_C, one.elem_H, one.O_C_ratio, one.heteroatom_ratio, one.heavy_atom_count_formula) == (180.06, 6.0, 12.0, 1.0, 0.5, 12.0)
    assert (one.has_kegg_xref, one.has_lipidmaps, one.has_aracyc, one.pmn_pathway_count, one.sem_carbohydrate) == (1.0, 1.0, 1.0, 2.0, 1.0)
    assert (rows["6"].has_formula, rows["6"].O_C_ratio, rows["6"].has_aracyc) == (0.0, 0.0, 0.0)
    assert [n for n in ("stars", "source_x", "mass", "has_ec") if recall.is_model_feature(n)] == ["mass"]


def test_recall_model_and_run(spark, built):
    rng = np.random.default_rng(2)
    rows = [(f"c{k % 40}", int(x + 0.3 * rng.normal() > 0), float(x), float(rng.normal()), float("nan") if k % 50 == 0 else 1.0) for k, x in enumerate(rng.normal(size=400))]
    frame = spark.createDataFrame(rows, "compound_id string, label int, x double, noise double, odd double")
    model, meta = recall.train(frame, ["x", "noise", "odd"])
    assert meta["cv_roc_auc_mean"] > 0.95 and meta["train_roc_auc"] > 0.95
    assert meta["top_positive_features"][0][0] == "x"
    assert model.score(frame).filter("ml_score between 0 and 1").count() == 400
    s, ranked = build.load(spark, built[0]), build.stage(spark, built[0], "ranked")
    files = [("AraCyc", built[0].pmn(spark, "aracyc_compounds")), ("PlantCyc", built[0].pmn(spark, "plantcyc_compounds"))]
    details = catalog.pmn_details(spark, files)
    one = ranked.filter("compound_id <> '1'")
    found = {(r.compound_id, r.pathway_name): r for r in recall.expanded(s, one, details).collect()}
    assert found["1", "sugar biosynthesis"].pathway_id == "AraCyc:GLC:sugar biosynthesis"
    assert (found["1", "sugar biosynthesis"].ec_numbers, found["1", "sugar biosynthesis"].reaction_equation) == (["EC-1.1.1.1", "EC-2.7.1.2"], "a -> b ; b -> c")
    pairs = recall.training_pairs(ranked, details).collect()
    good = {(r.compound_id, r.pathway_name.lower().strip("!")) for r in pairs if r.label}
    assert all((r.compound_id, r.pathway_name.lower().strip("!")) not in good for r in pairs if not r.label)
    stats = catalog.pmn_pathway_stats(spark, [("AraCyc", built[0].pmn(spark, "aracyc_pathways")), ("PlantCyc", built[0].pmn(spark, "plantcyc_pathways"))])
    ecs = stats.select("source_db", "name_key", F.array().cast("array<string>").alias("ecs"))
    wide = recall.pair_features(recall.expanded(s, one, details), recall.compound_features(s), recall.name_context(s), stats, ecs, spark.createDataFrame([("sugar biosynthesis pathway",)], "pathway_name string"))
    row = next(r for r in wide.collect() if r.pathway_name == "sugar biosynthesis")
    assert (row.has_reactome_match, row.pw_gene_count, row.semantic_consistency) == (1.0, 1.0, pytest.approx(1 / 3))
    meta = recall.run(built[0], s, one, details, stats, ecs)
    assert meta == {"status": "fallback", "reason": "insufficient training data"}
    assert read_tsv(built[0].index("ml_pathway_predictions.tsv")) == []
    assert len(read_tsv(built[0].index("expanded_candidates.tsv"))) == len(found)
    assert math.isclose(recall.FALLBACK, 0.5)
