"""Samples, candidates, folds and the published model, against plain Python; and the command line."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from siftwell.__main__ import main
from siftwell.plans import query as Q
from siftwell.plans import recall, training

from fixture import read_tsv


def test_subsets():
    assert training.subset_rows(["b", "a", "c", "a"], 50, 1) == [("a", "b"), ("a", "c"), ("b", "c"), ("a", "b", "c")]
    assert training.subset_rows(["a"], 50, 1) == []
    many = training.subset_rows([f"m{k}" for k in range(14)], 50, 1)
    assert len(many) == len(set(many)) == 50
    assert many == training.subset_rows([f"m{k}" for k in range(14)], 50, 1)
    assert all(2 <= len(x) <= 10 and list(x) == sorted(set(x)) for x in many)


@pytest.fixture(scope="module")
def world(spark):
    rows = [(f"P{p:02}", f"c{c:02}") for p in range(40) for c in range(60) if (c * 7 + p * 3) % 11 < 2 + p % 3]
    return rows, spark.createDataFrame(rows, "pathway_id string, member string").cache()


def test_generated_samples(spark, world):
    rows, membership = world
    split = training.split_compounds(membership).cache()
    sides = {r.member: r.split for r in split.collect()}
    total = len({m for _, m in rows})
    assert sum(s == "train" for s in sides.values()) == round(0.8 * total)
    samples, labels = training.generated(membership, split, limit=3)
    members = {}
    for r in samples.collect():
        members.setdefault((r.sample_id, r.split), set()).add(r.member)
    assert all(sides[m] == side for (_, side), ms in members.items() for m in ms)
    two_sided = {p for p in {p for p, _ in rows} if all(sum(sides[m] == s for q, m in rows if q == p) >= 2 for s in ("train", "test"))}
    want = {(i, p) for (i, _), ms in members.items() for p in two_sided if all((p, m) in set(rows) for m in ms)}
    assert {(r.sample_id, r.pathway_id) for r in labels.collect()} == want
    assert training.overlap(samples, labels)["shared_compound_count"] == 0
    assert training.duplicate_ids(samples.select("sample_id").distinct()).count() == 0


def test_candidates(spark, world):
    rows, membership = world
    samples = spark.createDataFrame([("s1", "c00", "train"), ("s1", "c11", "train"), ("s1", "c22", "train"), ("s2", "c01", "test"), ("s2", "c02", "test")], "sample_id string, member string, split string")
    labels = training.positives(samples, membership)
    structures = spark.createDataFrame([], "compound_id string, formula_key string, charge string, fp array<long>")
    parents = spark.createDataFrame([], "child string, parent string")
    got = training.candidates(samples, labels, membership, structures, parents, hard=3, total=8).collect()
    good = {(r.sample_id, r.pathway_id) for r in labels.collect()}
    sizes = {p: sum(q == p for q, _ in rows) for p, _ in rows}
    universe = len({m for _, m in rows})
    for s, ms in (("s1", ["c00", "c11", "c22"]), ("s2", ["c01", "c02"])):
        mine = {r.pathway_id: r for r in got if r.sample_id == s}
        assert {p for i, p in good if i == s} == {p for p, r in mine.items() if r.label == 1}
        assert sum(r.label == 0 for r in mine.values()) == 8
        ps = {}
        for p, r in mine.items():
            x = sum((p, m) in set(rows) for m in ms)
            assert (r.n_hits, r.n_group, r.n_target, r.n_universe) == (x, sizes[p], len(ms), universe)
            ps[p] = sum(math.comb(sizes[p], i) * math.comb(universe - sizes[p], len(ms) - i) for i in range(x, min(sizes[p], len(ms)) + 1)) / math.comb(universe, len(ms))
            assert r.p_value == pytest.approx(ps[p])
            if x < 2:
                ef = (x / len(ms)) / (sizes[p] / universe)
                assert r.score == pytest.approx(round(0.55 * (ef >= 1) + 0.3 * x / sizes[p] + 0.15 * (x > 0), 4))
        ranked = sorted(ps.values())
        adjusted = {p: min(1.0, *(q * len(ranked) / (k + 1) for k, q in enumerate(ranked) if q >= ps[p])) for p in ps}
        assert all(r.fdr == pytest.approx(adjusted[p]) for p, r in mine.items())
        assert all(r.set_size == len(ms) and r.ontology_diversity == 1.0 for r in mine.values())


def test_folds_and_published_model(spark, world, tmp_path):
    rows, membership = world
    empty = lambda schema: spark.createDataFrame([], schema)
    e = Q.Engine(
        spark, empty("compound_id string"), empty("compound_id string"), membership.withColumn("pathway_name", F.col("pathway_id")), empty("variant string, key string, compound_id string"),
        spark.createDataFrame([("c00", "CHEBI:0"), ("c01", "CHEBI:1")], "compound_id string, chebi_accession string"), empty("compound_id string, formula_key string, charge string, fp array<long>"),
        empty("pathway_id string"), empty("compound_id string"), empty("child string, parent string"),
    )
    flat, summary = training.run_folds(e, folds=2, limit=2)
    found = {r.metric: r.mean for r in summary.collect()}
    assert 0 < found["model_ndcg"] <= 1 and found["shared_compound_count"] == 0
    assert flat.select("fold_id").distinct().count() == 2
    folder = str(tmp_path / "model")
    assert training.load(spark, folder) == (None, "online_model_missing")
    made = training.publish(e, folder, limit=2)
    model, why = training.load(spark, folder)
    assert (why, model.features) == ("applied", training.FEATURES)
    samples, labels = training.deploy_samples(membership, limit=1)
    table = training.candidates(samples, labels, membership, e.structures, e.parents, total=3).cache()
    a, b = ({(r.sample_id, r.pathway_id): r.ml_score for r in m.score(table).collect()} for m in (made, model))
    assert a == pytest.approx(b)
    # Contributions and the mean row's log-odds are the score.
    shown = training.contributions(model, model.score(table))
    base = float(model.regression.intercept)
    for r in shown.limit(20).collect():
        assert 1 / (1 + math.exp(-base - sum(r.contributions.values()))) == pytest.approx(r.ml_score)
        assert len(r.top_positive) <= 5
    assert training.contribution_summary(shown).count() == len(training.FEATURES)
    assert training.importance(model, spark).count() == len(training.FEATURES)
    (tmp_path / "bad").mkdir()
    for name in ("regression", "scaler", "metadata.json"):
        (tmp_path / "bad" / name).write_text("no model")
    assert training.load(spark, str(tmp_path / "bad")) == (None, "online_model_unreadable")


def test_dataset_audit(spark, built, tmp_path):
    e = Q.Engine.load(spark, built[0], built[2])
    rows = ["sample_id\tcompounds\tpathway_id\tpathway_name\tsplit\tweight", "ok\t1;CHEBI:4;1\tPWY-1\t\ttrain\t2.5", "\t1;4\t\tcamphor degradation\ttest\tx", "split\t1;4\tPWY-1\t\tdev\t", "none\t ; \tPWY-1\t\ttrain\t", "bad\t1;999\tPWY-1\t\ttrain\t", "small\t1;1\tPWY-1\t\ttrain\t", "label\t1;4\tPWY-9\tno such\ttrain\t"]
    (tmp_path / "d.tsv").write_text("\n".join(rows) + "\n")
    good, audit = training.resolve_dataset(e, str(tmp_path / "d.tsv"), names=False, use_split=True)
    got = {}
    for r in good.collect():
        got.setdefault(r.sample_id, (set(), r.split, r.weight, tuple(r.pathway_ids)))[0].add(r.member)
    assert got == {"ok": ({"1", "4"}, "train", 2.5, ("PWY-1",)), "row_2": ({"1", "4"}, "test", 1.0, ("PWY-3",))}
    assert {r.sample_id: r.reason for r in audit.collect()} == {"split": "invalid_split", "none": "empty_compounds", "bad": "compound_resolution_failed", "small": "too_small_set", "label": "pathway_unmapped"}
    said = {r.sample_id: r.detail for r in audit.collect()}
    assert said["label"] == "unknown pathway_id=PWY-9 | unmapped pathway_name=no such"
    assert said["bad"] == "999: unknown ChEBI identifier: 999"
    named, partial = training.resolve_dataset(e, str(tmp_path / "d.tsv"), names=False, strict=False)
    assert {r.sample_id: r.reason for r in partial.filter("sample_id = 'bad'").collect()} in ({"bad": "too_small_set"}, {"bad": "compound_resolution_partial"})
    assert named.filter("sample_id = 'split'").count() == 2


def test_commands(spark, built, tmp_path, capsys):
    names = tmp_path / "set.txt"
    names.write_text("glucose record\n\nfancy berry\nshape one\n")
    work = built[0].workdir
    assert main(["query", "--workdir", work, "-q", "glucose record", "--no-fuzzy"], spark) == 0
    assert "sugar biosynthesis" in capsys.readouterr().out
    assert main(["enrich", "--workdir", work, "--input", str(names), "--out-prefix", f"{tmp_path}/out"], spark) == 0
    out = read_tsv(f"{tmp_path}/out_pathway_enrichment.tsv")
    assert [r["pathway_id"] for r in out] == ["PWY-1"]
    assert out[0]["rerank_reason"] == "online_model_missing"
    assert list(itertools.islice((r["input_name"] for r in read_tsv(f"{tmp_path}/out_metabolite_resolution.tsv")), 2)) == ["glucose record", "fancy berry"]
    assert recall.THRESHOLD == 0.55
