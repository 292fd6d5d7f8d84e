"""Each stage of the corpus pipeline against plain Python, on the smallest tables and on odd rows."""

import re

import pytest
from pyspark.sql import functions as F

from siftwell.llm import language_id, sentencepiece_fst

DATA = "/root/testdata/sf0.001"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def lines_lost(rows):
    """(doc_id, text) to the text without the lines that five documents share, the largest id's excepted."""
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = low(line.strip(" \t\n\x0b\x0c\r"))
            if i is not None and len(key) >= 40:
                holders.setdefault(key, set()).add(i)
    gone = {key: max(ids) for key, ids in holders.items() if len(ids) >= 5}
    keep = lambda i, line: i is None or gone.get(low(line.strip(" \t\n\x0b\x0c\r")), i) == i
    return [(i, None if text is None else "\n".join(x for x in text.split("\n") if keep(i, x))) for i, text in rows]


def classes(rows):
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for i, w in ((i, words(t)) for i, t in rows) if w and i is not None}
    top = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if top[a] != top[b] and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                    top[a] = top[b] = min(top[a], top[b])
                    changed = True
    return top


@pytest.fixture(scope="module")
def docs(spark):
    shared = "This line is shared by several documents of the odd rows below"
    odd = [(10_000 + k, f"{shared}\nown words number {k} of one odd document {k * 7}", "en", "odd", None) for k in range(6)]
    odd += [(20_000, None, "en", None, 1), (20_001, "", None, None, 1), (None, f"{shared}\nwithout any id", "en", "odd", 1), (20_002, "12 34 !", "en", None, 1), (20_003, "½ ² ① Ⅷ 日本" * 3, "en", None, 1)]
    odd += [(20_004, "the same row is twice in this table", "en", "odd", 1)] * 2 + [(20_005, "word " * 40_000, "en", "odd", 1)]
    given = spark.read.parquet(f"{DATA}/documents.parquet")
    both = given.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long"))
    clash = ["_dropped", "_bitmap", "_lost", "_spans", "_doc", "_tkey", "row", "id", "doc", "bitmap", "_ids", "class_id", "score", "held_out", "t"]
    return both.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in clash}).cache()


def rows_of(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def as_sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_stages(spark, docs):
    import corpus_pipeline as pipeline

    now = docs
    verdict = {(r.doc_id, r.lang_pred, r.score) for r in language_id.predict(docs.select("doc_id", "text"), language_id.train(docs)).collect()}
    keep = {i for i, lang, score in verdict if lang != "und" and score >= 0.4}
    before, now = rows_of(docs), pipeline.by_language(spark, docs, DATA).cache()
    assert now.columns == docs.columns
    assert as_sorted(rows_of(now)) == as_sorted(r for r in before if r[0] in keep)
    assert not {20_000, 20_001, 20_002} & {i for i, _ in rows_of(now)}
    before, now = rows_of(now), pipeline.by_line(spark, now, DATA).cache()
    assert now.columns == docs.columns
    assert as_sorted(rows_of(now)) == as_sorted(lines_lost(before))
    top = classes(rows_of(now))
    before, now = rows_of(now), pipeline.by_near_copy(spark, now, DATA).cache()
    assert now.columns == docs.columns
    assert as_sorted(rows_of(now)) == as_sorted(r for r in before if top.get(r[0], r[0]) == r[0])
    windows = set()
    for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    hit = lambda w: any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))
    before, now = rows_of(now), pipeline.by_benchmark(spark, now, DATA).cache()
    assert now.columns == docs.columns
    assert as_sorted(rows_of(now)) == as_sorted(r for r in before if not hit(words(r[1])))
    assert all(r._dropped == f"_dropped{r.doc_id}" and r.id == f"id{r.doc_id}" for r in now.collect() if r.doc_id is not None)
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    got = pipeline.to_pieces(spark, now, DATA).collect()
    assert as_sorted((r.doc_id, r.ids) for r in got) == as_sorted((i, theirs.encode(t)) for i, t in rows_of(now))
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in got)


def test_stages_of_an_empty_table(spark, docs):
    import corpus_pipeline as pipeline

    for name, stage in pipeline.STAGES:
        got = stage(spark, docs.limit(0), DATA)
        assert got.count() == 0
        assert name == "sentencepiece" or got.columns == docs.columns


def test_stages_without_the_one_before(spark, docs):
    """Nulls and empty texts, which the first stage would take, pass the others."""
    import corpus_pipeline as pipeline

    for _, stage in pipeline.STAGES[1:]:
        got = {r.doc_id: r for r in stage(spark, docs, DATA).collect()}
        assert {20_000, 20_001, 20_002, None} <= set(got)
