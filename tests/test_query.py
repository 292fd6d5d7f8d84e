"""Questions to the built work folder, against answers worked out by hand."""

import math
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from siftwell.functions import text as T
from siftwell.plans import query as Q

from fixture import read_tsv


@pytest.fixture(scope="module")
def engine(spark, built):
    paths, _, fps = built
    support = "aracyc_pathway_id\tath_pathway_id\tath_pathway_name\talignment_score\talignment_confidence\nPWY-1\tath1\told\t2.5\tlow\nPWY-1\tath2\tbest\t7.25\thigh\n\tath3\tx\t9\thigh\n"
    (spark.createDataFrame([(line,) for line in support.split("\n")[:-1]], "v string").coalesce(1).write.mode("overwrite").text(paths.index("kegg_ath_to_aracyc_pathway_best.tsv")))
    e = Q.Engine.load(spark, paths, fps)
    for name in ("mappings", "pathways", "membership", "names", "compounds", "structures", "support"):
        setattr(e, name, getattr(e, name).cache())
    return e


@pytest.fixture(scope="module")
def answers(spark, engine):
    texts = [
        "glucose record", " D-Glucose ", "fancy berry", "camphr", "camphr ester", "dextrose", "Beta things", "", "AAAAAAAAAAAAAA-BBBBBBBBBB-N", "block:CCCCCCCCCCCCCC", "block:ZZZZZZZZZZZZZZ", "smiles: CCC", "smiles:NOPE", "zzz qqq",
        "nothing known", "ZZZZZZZZZZZZZZ-BBBBBBBBBB-N", "commn name",
    ]
    rows = engine.query(spark.createDataFrame(list(enumerate(texts)), "qid int, query string"), top_k=3).collect()
    assert len(rows) == len(texts)
    return {r.query: r for r in rows}


def test_direct_names(answers):
    for text in ("glucose record", " D-Glucose "):
        a = answers[text]
        assert (a.match_type, a.resolution_path, a.matched_compound, a.note) == ("direct", "plain_text -> arabidopsis_direct", "D-glucose", "")
        assert [m.compound_id for m in a.mappings] == ["1"]
        assert [(p.pathway_id, p.kegg_ath_pathway_id, p.kegg_alignment_score) for p in a.pathways][0] == ("PWY-1", "ath2", 7.25)
        assert [p.kegg_support_present for p in a.pathways] == [True, False]
    assert answers["fancy berry"].mappings[0].aracyc_compound_id == "BERRY"
    assert "#1 [high] sugar biosynthesis" in Q.show(answers["glucose record"])
    assert "KEGG ath support: ath2 (best) [high, score=7.2500]" in Q.show(answers["glucose record"])


def test_fuzzy_names(answers):
    a = answers["camphr"]
    assert (a.match_type, a.resolution_path, a.matched_compound) == ("fuzzy", "plain_text -> arabidopsis_fuzzy", "camphor")
    assert a.did_you_mean == ["camphor / camphor ester"]
    # Of a name of several words the form without blanks is as near as the exact one, so neither is ahead.
    a = answers["camphr ester"]
    assert (a.match_type, a.resolution_path, a.did_you_mean, a.note) == ("", "plain_text", ["camphor / camphor ester"], Q.NOTES["suggested"])


def test_recovered_names(answers):
    # A synonym of compound 1, which has a mapping of its own.
    a = answers["dextrose"]
    assert (a.match_type, a.resolution_path, a.recovered_chebi_id, a.projection_type, a.note) == ("recovered_from_chebi", "plain_text -> chebi_exact -> aracyc_mapping", "CHEBI:1", "", "")
    a = answers["nothing known"]
    assert (a.match_type, a.resolution_path, a.recovered_chebi_id, a.did_you_mean) == ("", "plain_text -> chebi_exact", "CHEBI:6", ["nothing known (CHEBI:6)"])
    assert a.note.startswith("Recovered 1 strict ChEBI candidates and ranked them")


def test_structures_and_failures(answers):
    a = answers["AAAAAAAAAAAAAA-BBBBBBBBBB-N"]
    assert (a.match_type, a.resolution_path, a.matched_compound, a.neighbor_similarity) == ("exact_structure", "inchikey -> exact_structure", "D-glucose", 1.0)
    a = answers["block:CCCCCCCCCCCCCC"]
    assert (a.match_type, a.neighbor_similarity, a.matched_compound) == ("structural_neighbor", 0.9, "shape one")
    best = a.pathways[0]
    assert best.reason.endswith("; structural_similarity=0.900")
    assert answers["smiles: CCC"].resolution_path == "smiles -> exact_structure"
    notes = {t: answers[t].note for t in ("", "block:ZZZZZZZZZZZZZZ", "smiles:NOPE", "zzz qqq", "ZZZZZZZZZZZZZZ-BBBBBBBBBB-N")}
    assert list(notes.values()) == [Q.NOTES["empty"], Q.NOTES["block"], Q.NOTES["smiles"], Q.NOTES["none"], Q.NOTES["key"]]
    assert answers["zzz qqq"].resolution_path == "plain_text"
    assert Q.show(answers["zzz qqq"]).endswith("note: No AraCyc/PlantCyc mapping found.")


def test_projection_by_structure(spark, engine):
    """A recovered compound without a mapping: by key, by block and formula, by fingerprint with formula, charge and mass."""
    index = spark.createDataFrame([("10", "K1", "B1", "F", "0", 100.0, [7]), ("11", "K2", "B2", "F", "", None, [15]), ("12", "K3", "B3", "F", "1", 100.0, [15]), ("13", "K4", "B3", "G", "0", 100.0, [15])], "compound_id string, key string, block string, formula_key string, charge string, exact_mass double, fp array<long>")
    own = [("20", "K1", "F", "0", 100.0, [15]), ("21", "B2-x", "F", "0", 100.4, [15]), ("22", "zz", "F", "0", 100.0, [15]), ("23", "", "", "", None, [15])]
    columns = "compound_id string, standard_inchi_key string, formula_key string, charge string, exact_mass double, fp array<long>"
    e = Q.Engine(**(engine.__dict__ | {"structures": spark.createDataFrame(own, columns), "mappings": engine.mappings.limit(0)}))
    asked = spark.createDataFrame([(k, i[0]) for k, i in enumerate(own)], "qid int, compound_id string")
    got = {}
    for r in e.project(asked, index).collect():
        got.setdefault(r.candidate, set()).add((r.tier, r.compound_id, round(r.similarity, 3)))
    assert got == {"20": {(1, "10", 1.0)}, "21": {(2, "11", 1.0)}, "22": {(2, "11", 1.0)}}


def test_fuzzy_scores_lose_nothing(spark):
    names = ["glucose", "glucosee", "fructose", "fructose 6 phosphate", "galactose", "l glutamate", "glutamate", "sucrose synthase", "a", "alpha glucose"]
    asked = ["glucoes", "D-glutamate", "fructose-6-phosphat", "galactoses", "alpha-glucos", "sucrose  synthases"]
    q = spark.createDataFrame(list(enumerate(asked)), "qid int, query string").withColumn("variants", T.variants(F.col("query")))
    got = {(r.qid, r.name): r.ratio for r in Q.fuzzy_scores(q, spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    want = {}
    for r in q.collect():
        for name in names:
            a, b = len(r.variants.exact), len(name)
            if abs(a - b) / max(a, b) <= 0.4:
                ratio = max(SequenceMatcher(None, v, name).ratio() for v in r.variants if v)
                if ratio >= 0.85:
                    want[r.qid, name] = ratio
    assert got == pytest.approx(want)


def test_set_query(spark, engine, built, tmp_path):
    names = ["glucose record", "unheard of", "Beta things", "fancy berry", "shape one", "dextrose", "common name"]
    inputs, rows = engine.enrich(spark.createDataFrame([(k + 1, n) for k, n in enumerate(names)], "input_order int, input_name string"))
    inputs, rows = inputs.cache(), rows.cache()
    by_name = {r.input_name: r for r in inputs.collect()}
    assert (by_name["unheard of"].resolution_status, by_name["unheard of"].included_in_target) == ("unmapped", False)
    assert (by_name["Beta things"].resolution_status, by_name["Beta things"].included_in_target) == ("resolved", False)
    assert by_name["Beta things"].note == Q.NOTES["outside"]
    got = rows.collect()
    # Five compounds have AraCyc pathways with an id: 1, 2, 4, 7 and 8. Four of them are asked for, all on PWY-1.
    one = next(r for r in got if r.pathway_id == "PWY-1")
    assert (one.n_universe, one.n_group, one.n_target, one.n_hits) == (5, 4, 4, 4)
    assert one.p_value == pytest.approx(1 / math.comb(5, 4))
    assert one.hit_ids == ["1", "4", "7", "8"]
    # One candidate only: its share of the enrichment is whole.
    scores = [1.0, 0.73, 0.85, 0.8]
    assert one.score == round(0.55 + 0.30 * 1.0 + 0.15 * sum(scores) / 4, 4)
    assert (one.n_direct, one.baseline_rank, one.rerank_reason, one.ml_rank, one.kegg_ath_pathway_id) == (4, 1, "online_model_missing", None, "ath2")
    Q.write_set_query(engine, inputs, rows, f"{tmp_path}/out")
    out = read_tsv(f"{tmp_path}/out_pathway_enrichment.tsv")
    assert (out[0]["n"], out[0]["N"], out[0]["p_value"], out[0]["enrichment_factor"], out[0]["kegg_alignment_score"], out[0]["ml_score"]) == ("4", "5", "0.2", "1.25", "7.25", "")
    assert len(out[0]) == 39
    resolved = read_tsv(f"{tmp_path}/out_metabolite_resolution.tsv")
    assert [r["input_order"] for r in resolved] == [str(k + 1) for k in range(len(names))]
    assert (resolved[1]["match_score"], resolved[0]["match_score"], resolved[0]["included_in_target"]) == ("", "1.0000", "true")
    assert engine.small_sample(inputs) == "small sample size (U=5, S=4), enrichment results may be unreliable"
    one_only = engine.enrich(spark.createDataFrame([(1, "glucose record")], "input_order int, input_name string"))[1]
    assert one_only.count() == 0


def test_set_features(spark):
    members = spark.createDataFrame([("s", "1"), ("s", "2"), ("s", "3"), ("t", "1")], "q string, compound_id string")
    structures = spark.createDataFrame([("1", "F", "0", [3]), ("2", "F", "", [1]), ("3", "", "", None)], "compound_id string, formula_key string, charge string, fp array<long>")
    parents = spark.createDataFrame([("1", "9"), ("2", "9")], "child string, parent string")
    got = {r.q: r for r in Q.set_features(members, structures, parents, ["q"]).collect()}
    s = got["s"]
    assert (s.set_size, s.pairwise_tanimoto_mean, s.ontology_diversity, s.formula_diversity, s.charge_diversity) == (3.0, 0.5, pytest.approx(2 / 3), pytest.approx(1 / 3), pytest.approx(1 / 3))
    assert (got["t"].set_size, got["t"].pairwise_tanimoto_max) == (1.0, 0.0)
