import hashlib
import html
import math
import random
import re
import unicodedata
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell import constants
from siftwell.functions import numbers
from siftwell.functions import similarity as sim
from siftwell.functions import stats
from siftwell.functions import text as T
from siftwell.operators import evaluate, structure
from siftwell.operators import resolve as R
from siftwell.plans import matching
from siftwell.sources import readers
from siftwell.streaming import resolution


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.select(expression.alias("x")).first().x


@pytest.mark.parametrize(("raw", "want"), [("<i>&alpha;</i>-D-Glucose", "alpha d glucose"), ("Café's", "cafes"), ("", ""), ("N,N'-Di", "n n di"), ("5’-x`y", "5 x y"), ("ΑΒ", "alpha beta")])
def test_normalize_name(spark, raw, want):
    assert one(spark, T.normalize_name(F.col("a")), a=raw) == want


def test_variants(spark):
    v = one(spark, T.variants(F.col("a")), a="trans-Berries glasses")
    assert (v.compact, v.singular, v.stereo_stripped) == ("transberriesglasses", "tran berry glasses", "tran berry glasses")
    v = one(spark, T.variants(F.col("a")), a="cis-D-berries")
    assert (v.singular, v.stereo_stripped) == ("cis d berry", "berry")
    assert one(spark, T.variants(F.col("a")), a="alpha-D").stereo_stripped == ""


@pytest.mark.parametrize(("n", "k", "d", "x"), [(50, 10, 12, 4), (2000, 80, 300, 25), (30, 29, 20, 20), (10, 3, 3, 0), (100, 5, 5, 6)])
def test_hypergeometric_tail(spark, n, k, d, x):
    want = sum(math.comb(k, i) * math.comb(n - k, d - i) for i in range(x, min(k, d) + 1) if d - i <= n - k) / math.comb(n, d)
    assert one(spark, stats.hypergeom_sf("n", "k", "d", "x"), n=n, k=k, d=d, x=x) == pytest.approx(want, abs=1e-11)


def test_deletion_keys_recall_two_insertions(spark):
    a = spark.createDataFrame([("glucose",)], ["a"])
    b = spark.createDataFrame([("gluxcoyse",), ("glucos",), ("galactose",)], ["b"])
    assert {(r.b, r.distance) for r in R.fuzzy_join(a, "a", b, "b").collect()} == {("gluxcoyse", 2), ("glucos", 1)}


def test_difflib_ratio_of_all_near_lengths(spark, tmp_path):
    names = ["cold anvil", "old anvil", "cold", "bold anvils", "a", "ab", "", "a much longer name than these", "other name of that length now"]
    spark.createDataFrame([(n,) for n in [*names, "cold", None]], "p_name string").write.parquet(str(tmp_path / "part.parquet"))
    got = {(r.p_name, r.other): r.ratio for r in matching.difflib_ratio(spark, str(tmp_path)).collect()}
    near = [(a, b) for a in names for b in names if max(len(a), len(b)) and abs(len(a) - len(b)) <= 0.4 * max(len(a), len(b))]
    assert got == {(a, b): round(SequenceMatcher(None, a, b).ratio(), 6) for a, b in near}


def test_bounded_edits_and_fits(spark):
    pairs = [("glucose", "glucse"), ("glucose", "gluse"), ("glucose", "fructose"), ("", "a"), ("ab", "ab")]
    got = spark.createDataFrame(pairs, "a string, b string").select(*[sim.within_edits(F.col("a"), F.col("b"), k).alias(f"k{k}") for k in (1, 2)]).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, True), (False, False), (True, True), (True, True)]
    sets = spark.createDataFrame([(["x"], ["x", "y"]), (["x"], ["z"]), ([], ["z"])], "a array<string>, b array<string>")
    got = sets.select(sim.formulas_fit(F.col("a"), F.col("b")), sim.overlap_coefficient(F.col("a"), F.col("b")), sim.jaccard(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(True, 1.0, 0.5), (False, 0.0, 0.0), (True, 0.0, 0.0)]
    n, k = spark.createDataFrame([(50, 7)], "n int, k int").selectExpr(f"exp({stats.log_choose('n', 'k')}) AS x", "k").first()
    assert n == pytest.approx(math.comb(50, 7), rel=1e-10)


@pytest.mark.parametrize(("n", "k", "d", "x"), [(3_000_000, 1_000_000, 900_000, 300_900), (3_000_000, 1_000_000, 900_000, 299_000), (1_000_000, 500, 2_000, 9), (100_000, 99_000, 98_000, 97_030)])
def test_hypergeometric_tail_of_large_groups(spark, n, k, d, x):
    logs = lambda i: math.lgamma(k + 1) - math.lgamma(i + 1) - math.lgamma(k - i + 1) + math.lgamma(n - k + 1) - math.lgamma(d - i + 1) - math.lgamma(n - k - d + i + 1) - math.lgamma(n + 1) + math.lgamma(d + 1) + math.lgamma(n - d + 1)
    want = math.fsum(math.exp(logs(i)) for i in range(max(x, d + k - n), min(k, d) + 1))
    assert one(spark, stats.hypergeom_sf("n", "k", "d", "x"), n=n, k=k, d=d, x=x) == pytest.approx(min(1.0, want), rel=1e-5)


def test_exact_round_and_formats(spark):
    values = [2.675, 0.83875, 0.0125, 0.0375, 0.5, 1.005, 0.00005, 0.00015, 7.89999, 0.0, -0.0125, 12.34565]
    got = [r.x for r in spark.createDataFrame([(v,) for v in values], "v double").select(numbers.exact_round(F.col("v")).alias("x")).collect()]
    assert got[:-1] == [round(v, 4) for v in values[:-1]]
    assert [one(spark, numbers.exact_round(F.col("a"), 2), a=v) for v in (2.675, 1.005)] == [2.67, 1.0]
    assert [one(spark, numbers.formatted(F.col("a"), s), a=v) for v, s in ((0.5, ".6g"), (1e-9, ".6g"), (0.25, ".4f"))] == ["0.5", "1e-09", "0.2500"]


def test_token_edits_are_the_rules(spark):
    stereo, ignorable = set(constants.LEADING_STEREO_TOKENS), set(constants.IGNORABLE_FUZZY_TOKENS)

    def near(a, b):
        if a == b:
            return True
        if len(a) == len(b):
            off = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
            return len(off) == 1 and levenshtein(*off[0]) <= 1
        if abs(len(a) - len(b)) != 1:
            return False
        a, b = sorted((a, b), key=len)
        first = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
        return b[first + 1 :] == a[first:] and (b[first].isdigit() or b[first] in stereo | ignorable)

    def levenshtein(x, y):
        row = list(range(len(y) + 1))
        for i, p in enumerate(x, 1):
            row, last = [i], row
            for j, q in enumerate(y, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (p != q)))
        return row[-1]

    rng = random.Random(1)
    words = ["d", "glucose", "glucos", "acid", "5", "hydrate", "acids"]
    rows = [([rng.choice(words) for _ in range(rng.randint(1, 4))], [rng.choice(words) for _ in range(rng.randint(1, 4))]) for _ in range(600)]
    got = [r.x for r in spark.createDataFrame(rows, "a array<string>, b array<string>").select(T.within_one_token(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == [near(tuple(a), tuple(b)) for a, b in rows]


def test_dice_join_loses_nothing(spark):
    rng = random.Random(2)
    words = ["the"] * 3 + [f"w{k}" for k in range(12)]
    sets = lambda n: [(k, sorted({rng.choice(words) for _ in range(rng.randint(1, 7))})) for k in range(n)]
    left, right = sets(60), sets(60)
    for least in (0.4, 0.6, 0.85):
        got = {(r.i, r.j): r.dice for r in R.token_dice_join(spark.createDataFrame(left, "i long, s array<string>"), "i", F.col("s"), spark.createDataFrame(right, "j long, t array<string>"), "j", F.col("t"), least).collect()}
        want = {(i, j): d for i, a in left for j, b in right if (d := 2 * len(set(a) & set(b)) / (len(a) + len(b))) >= least}
        assert got == pytest.approx(want)


def test_nearest_and_percentiles(spark):
    rng = random.Random(3)
    rows = [(k, [rng.getrandbits(20), rng.getrandbits(20)]) for k in range(80)] + [(80, [0]), (81, None), (None, [1])]
    frame = spark.createDataFrame(rows, "id long, fp array<long>")
    got = {}
    for r in structure.nearest(frame.filter("id % 10 = 0"), frame, "id", "fp", 3, 0.3).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.record_id, round(r.similarity, 9)))
    bits = {i: fp[0] | (fp[1] if len(fp) > 1 else 0) << 64 for i, fp in rows if fp is not None and i is not None}
    for q in range(0, 81, 10):
        like = {i: (bin(bits[q] & b).count("1") / bin(bits[q] | b).count("1") if bits[q] | b else 0.0) for i, b in bits.items() if i != q}
        want = sorted(((-v, i) for i, v in like.items() if v >= 0.3))[:3]
        assert got.get(q, []) == [(i, round(-v, 9)) for v, i in want]
    values = [rng.choice([1.0, 2.0, 2.5, 7.0, rng.random()]) for _ in range(501)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    row = evaluate.percentiles(frame, "v", [0.0, 0.5, 0.9, 0.99, 1.0]).first()
    assert list(row) == pytest.approx(np.percentile(values, [0, 50, 90, 99, 100]).tolist())
    assert list(evaluate.percentiles(frame.limit(0), "v", [0.5]).first()) == [None]


def test_names_beyond_ascii(spark, tmp_path):
    """Both normalisers against plain Python, over whole texts."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in matching.nfkd_normalise(spark, "/root/testdata/sf0.001").collect()}
    for r in docs.collect():
        text = html.unescape(r.text or "")
        for a, b in constants.GREEK.items():
            text = text.replace(a, f" {b} ").replace(a.upper(), f" {b} ")
        text = "".join(c for c in unicodedata.normalize("NFKD", re.sub(r"<[^>]+>", " ", text)) if not unicodedata.combining(c)).lower().replace("'", "")
        fold = unicodedata.normalize("NFKD", r.text or "").encode("ascii", "ignore").decode().lower()
        for mine, want in ((got[r.doc_id].name_md5, text), (got[r.doc_id].folded_md5, fold)):
            whole = " ".join(re.findall("[a-z0-9]+", want))
            assert mine == (None if r.text is None else hashlib.md5(whole.encode()).hexdigest())


def test_stream_of_names(spark, tmp_path):
    index = spark.createDataFrame([("p1", "exact", "d glucose"), ("p2", "exact", "d glucose"), ("p3", "compact", "dglucose")], "id string, variant string, key string")
    spark.createDataFrame([("D-Glucose",), ("none",)], "name string").write.parquet(str(tmp_path / "in"))
    stream = resolution.resolve_stream(spark.readStream.schema("name string").parquet(str(tmp_path / "in")), "name", index, "id")
    running = stream.writeStream.format("memory").queryName("named").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    running.awaitTermination(120)
    assert sorted((r.name, r.id) for r in spark.table("named").collect() if r.id) == [("D-Glucose", "p1"), ("D-Glucose", "p2")]
    assert spark.table("named").count() == 3


def test_tanimoto_and_dice(spark):
    assert one(spark, sim.tanimoto(F.col("a"), F.col("b")), a=[7, 0], b=[3, 1]) == pytest.approx(0.5)
    assert one(spark, sim.dice(F.col("a"), F.col("b")), a=["x", "y"], b=["y", "z"]) == pytest.approx(0.5)


def test_roots_of_chains_and_cycles(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (8, 9), (9, 8)], ["child", "parent"])
    got = {r.child: (r.root, r.depth) for r in R.roots(edges, "child", "parent").collect()}
    assert got == {2: (1, 1), 3: (1, 2), 4: (1, 3), 8: (9, -1), 9: (8, -1)}


def test_roots_of_deep_chains_and_long_cycles(spark):
    chain = [(k, k - 1) for k in range(1, 2501)]
    cycle = [(10_000 + k, 10_000 + (k + 1) % 300) for k in range(300)] + [(20_000, 10_050)]
    got = {r.child: (r.root, r.depth) for r in R.roots(spark.createDataFrame(chain + cycle, ["child", "parent"]), "child", "parent").collect()}
    around = {10_000 + k: (10_000 + (k - 1) % 300, -1) for k in range(300)}
    assert got == {k: (0, k) for k, _ in chain} | around | {20_000: (10_049, -1)}


def test_root_ancestor_of_a_long_conversation(spark, tmp_path):
    spark.range(1200).selectExpr("1L AS conv_id", "id AS turn").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.child: (r.root, r.depth) for r in matching.root_ancestor(spark, str(tmp_path)).collect()}
    assert got == {1000 + k: (1000, k) for k in range(1, 1200)}


def test_readers(spark, tmp_path):
    (tmp_path / "c.tsv").write_text('name\tid\textra\n"a"" x" b\t1\tz\n\t2\nc "q"\t3\t\n')
    got = readers.tsv(spark, str(tmp_path / "c.tsv"), ["id", "name"], ["absent"]).orderBy("_seq").collect()
    assert [(r.id, r.name, r.absent) for r in got] == [("1", 'a" x b', ""), ("2", "", ""), ("3", 'c "q"', "")]
    with pytest.raises(ValueError, match="other"):
        readers.tsv(spark, str(tmp_path / "c.tsv"), ["other"])
    (tmp_path / "h.txt").write_text("+C\nAMetabolism\nB Carbon\nC    00010  Glycolysis\nB Energy\nC    00190  Oxidative\n")
    got = [tuple(r) for r in readers.hierarchy(spark, str(tmp_path / "h.txt")).orderBy("pathway_id").collect()]
    assert got == [("00010", "Metabolism", "Carbon", "Glycolysis"), ("00190", "Metabolism", "Energy", "Oxidative")]
    (tmp_path / "g.obo").write_text("format-version: 1.2\n\n[Term]\nid: GO:1\nname: one\nnamespace: biological_process\n\n[Term]\nid: GO:2\nname: two\nnamespace: molecular_function\n")
    assert [tuple(r) for r in readers.obo_terms(spark, str(tmp_path / "g.obo")).collect()] == [("GO:1", "one")]
    fields = ["TAIR", "x", "AT1G01010", "NOT", "GO:0000001", "r", "e", "w", "P", "n", "AT1G01010"]
    good = [*fields[:3], "", *fields[4:]]
    (tmp_path / "a.gaf").write_text("!c\n" + "\t".join(fields) + "\n" + "\t".join(good) + "\n")
    assert [tuple(r) for r in readers.gaf_processes(spark, str(tmp_path / "a.gaf")).collect()] == [("AT1G01010", "GO:0000001")]
    (tmp_path / "s.sdf").write_text("mol\nM  END\n> <LM_ID>\nLM1\n\n> <SYNONYMS>\na;\nb\n\n$$$$\nmol\n> <LM_ID>\nLM2\n\n$$$$\n")
    rows = {r.tags["LM_ID"]: r.tags for r in readers.sdf(spark, str(tmp_path / "s.sdf")).collect()}
    assert rows["LM1"]["SYNONYMS"] == "a;\nb"
    assert set(rows) == {"LM1", "LM2"}
