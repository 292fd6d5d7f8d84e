"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and on odd rows."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwell.llm import chat_tree, decontaminate, exact_search, fm_index, language_id, lattice, license_scan, line_dedup, near_dedup, queries, sentencepiece_fst, token_counts, url_filter

DATA = "/root/testdata/sf0.001"
LONG = "word " * 30_000
DOCS = "doc_id long, text string, lang string, score double, bitmap string, class string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and very long texts, repeated rows, extra columns with clashing names."""
    rows = [(1, None, None, 0.5, "x", "y"), (2, "", "en", None, None, None), (None, "same words in this text here", "en", 0.0, "", ""), (3, LONG, "en", 1.0, "x", "y")]
    rows += [(4, "same words in this text here", "en", 1.0, "x", "y")] * 2 + [(5, "same words in this text here", "de", 1.0, "x", "y"), (6, "12 34 !!", "de", 1.0, "x", "y")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text or ""))


def test_chat_round_trip_and_shared_prefix(spark):
    odd_text = "a<|im_end|><\\|b<\\\\|<|<"
    rows = [(1, 0, "user", odd_text), (1, 1, "assistant", None), (2, 0, "user", odd_text), (2, 1, "assistant", odd_text), (3, 0, "us\ner\\n", ""), (None, None, None, None), (3, 1, "assistant", LONG)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    packs = chat_tree.pack_conversations(df)
    got = {r.conv_id: r for r in chat_tree.read_back(packs).collect()}
    for conv in (1, 2, 3, None):
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1] or 0)]
        both = "".join(f"{a}\n{b}\n" for a, b in turns)
        said = "".join(b for a, b in turns if a == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256(both.encode()).hexdigest()
        assert (got[conv].n_turns, got[conv].loss_chars, got[conv].loss_sha256) == (len(turns), len(said), hashlib.sha256(said.encode()).hexdigest())
    pack = chat_tree.Pack()
    pack.add(1, [("user", "q"), ("assistant", "a")])
    pack.add(2, [("user", "q"), ("assistant", "b")])
    assert len(pack.segments) == 3
    assert pack.segments[1][2] == pack.segments[2][2] == pack.segments[0][1]
    assert pack.attends[2] == [(0, pack.segments[0][1])]


def test_chat_of_odd_tables(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "same", 5, "x")] * 3 + [(1, 0, "user", None, 5, "x"), (2, None, None, "", 5, None)], "conv_id long, turn long, role string, text string, turns long, path string")
    got = {r.conv_id: r for r in chat_tree.read_back(chat_tree.pack_conversations(rows)).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[2].n_turns, got[2].loss_chars) == (4, 12, 1, 0)
    assert got[1].turns_sha256 == hashlib.sha256(b"assistant\nsame\n" * 3 + b"user\n\n").hexdigest()
    assert chat_tree.read_back(chat_tree.pack_conversations(rows.limit(0))).count() == 0


def test_line_bitmaps(spark, odd, none):
    line = "A line that is certainly longer than forty characters, it is"
    rows = [(k, f"{line if k % 2 else line.upper() + ' '}\nown line {k} of this document that is long enough to count\n{line}") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs)).collect()}
    assert got[5].text == rows[5][1]
    assert all(got[k].text == rows[k][1].split("\n")[1] and got[k]._dropped == 2 for k in range(5))
    assert line_dedup.apply_bitmaps(odd, line_dedup.line_bitmaps(odd)).count() == odd.count()
    assert line_dedup.line_bitmaps(none).count() == 0
    assert line_dedup.kept_lines(line_dedup.keep_bitmap(10, [0, 9]), 10).tolist() == [False] + [True] * 8 + [False]


def test_url_rules_and_propagation(spark):
    rows = [
        (1, "https://a.example.com/en/7x?q", None), (2, "HTTP://B.Example.com/en/8", ""), (3, None, None), (4, "no host", None), (5, "http://x.net/de/1", ""), (6, "http://y.example.net/de/8", ""),
        (7, "http://bad.io/1", '<a href="http://b.example.com/en/1">'), (8, "http://good.io/", '<a href="http://other.io/">'), (9, "http://lone.io/p", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("rule", F.lit(1)).withColumn("trust", F.lit(1))
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert [(got[k].rule, got[k].verdict) for k in (1, 2, 5, 6)] == [("example.com/en/7", "allow"), ("com/en/", "block"), ("net/de/", "allow"), ("example.net/de/8", "block")]
    assert (got[3].host, got[3].path, got[3].verdict, got[4].host) == ("", "", "allow", "")
    assert got[7].verdict == "block"
    assert got[9].verdict == "allow"
    edges = spark.createDataFrame([("a", "b", 2.0), ("b", "c", 1.0), ("a", "c", 2.0)], "source string, target string, weight double")
    seeds = spark.createDataFrame([("a", 1.0, 0.0), ("c", 0.0, 1.0)], "host string, allowed double, blocked double")
    rank = {r.host: (r.trust, r.distrust) for r in url_filter.propagate(seeds, edges).collect()}
    m = np.array([[0, 0.5, 0.5], [0, 0, 1], [0, 0, 0]])
    back = np.array([[0, 1, 2 / 3], [0, 0, 1 / 3], [0, 0, 0]])
    t, d = np.array([1.0, 0, 0]), np.array([0, 0, 1.0])
    for _ in range(300):
        t, d = 0.15 * np.array([1, 0, 0]) + 0.85 * t @ m, 0.15 * np.array([0, 0, 1]) + 0.85 * back @ d
    for k, h in enumerate("abc"):
        assert rank[h] == pytest.approx((t[k], d[k]), abs=2 * url_filter.TOLERANCE)


def _judged(rows):
    """Plain Python of the url filter: page_id, host, path, rule, verdict of (page_id, url, html)."""
    pages, links = [], defaultdict(float)
    for i, url, html in rows:
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = (low(m[1]), m[2]) if m else ("", "")
        fits = [(len(r), r, v) for v, r in url_filter.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        pages.append((i, host, path, *(max(fits)[1:] if fits else (None, None))))
        for other in re.findall(r"(?i)(?:href|src)\s*=\s*[\"']?(?:https?:)?//([^/?#\"'\s<>]+)", html or ""):
            if host and host != low(other):
                links[host, low(other)] += 1
    for host in {p[1] for p in pages} | {b for _, b in links}:
        labels = host.split(".")
        for k in range(len(labels) - 2):
            up = (".".join(labels[k:]), ".".join(labels[k + 1 :]))
            seen = links.setdefault(("parents", ""), set())
            if up not in seen:
                seen.add(up)
    parents = links.pop(("parents", ""), set())
    for a, b in parents:
        links[a, b] += 1
        links[b, a] += 1
    out_all, in_all = defaultdict(float), defaultdict(float)
    for (a, b), w in links.items():
        out_all[a] += w
        in_all[b] += w
    seed = [defaultdict(float), defaultdict(float)]
    for _, host, _, _, verdict in pages:
        if host and verdict:
            seed[verdict == "block"][host] += 1
    total = [sum(s.values()) or 1 for s in seed]
    rank = [{h: n / t for h, n in s.items()} for s, t in zip(seed, total, strict=True)]
    start = [dict(r) for r in rank]
    for _ in range(200):
        new = [defaultdict(float, {h: 0.15 * x for h, x in s.items()}) for s in start]
        for (a, b), w in links.items():
            new[0][b] += 0.85 * rank[0].get(a, 0) * w / out_all[a]
            new[1][a] += 0.85 * rank[1].get(b, 0) * w / in_all[b]
        rank = new
    out = {}
    for i, host, path, rule, verdict in pages:
        t, d = rank[0].get(host, 0), rank[1].get(host, 0)
        near = host and t + d and abs(d / (t + d) - 0.5) < 1e-3
        out.setdefault(i, []).append((host, path, rule, verdict or (None if near else "block" if host and t + d and d / (t + d) >= 0.5 else "allow")))
    return out


def test_url_filter_is_plain_pythons(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    rows += [(-1, "http://a.b.c.d.io/" + "x" * 100_000, '<a href="//e.io/"><img SRC=http://f.a.b.c.d.io/1>'), (None, "http://e.io", None), (-2, "", "x"), (-2, "", "x"), (-3, "://", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("host", "path", "rule", "verdict", "hit", "trust")})
    want = _judged(rows)
    got = defaultdict(list)
    for r in url_filter.judge(frame).collect():
        got[r.page_id].append((r.host, r.path, r.rule, r.verdict))
    assert set(got) == set(want)
    for i in want:
        assert len(got[i]) == len(want[i])
        for a, b in zip(sorted(got[i], key=str), sorted(want[i], key=str), strict=True):
            assert a[:3] == b[:3]
            assert b[3] in (None, a[3])
    assert url_filter.judge(frame.limit(0)).count() == 0


def test_sentencepiece_is_the_librarys(odd, none):
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    mine = sentencepiece_fst.compile_model()
    rng = np.random.default_rng(3)
    letters = list("ab theinsoncl  \n\tÉéıß日本語🤗.,-_()019AEIOUqxz▁")
    for _ in range(3000):
        text = "".join(rng.choice(letters, rng.integers(0, 30)))
        ids = mine.encode(text)
        assert ids == theirs.encode(text)
        assert mine.decode(ids) == text.replace("▁", " ")
    got = sentencepiece_fst.encode(odd).collect()
    assert len(got) == odd.count()
    assert {r.doc_id: len(r._ids) for r in got}[2] == 0
    assert sentencepiece_fst.encode(none).count() == 0


@pytest.mark.parametrize("run", ["7", "0123456789", "日", "日本語中文字", "。", "🤗", "\x01\x02\x7f", "ab", "aaab", " ", "\n ", "é̈"])
def test_sentencepiece_of_long_runs(run):
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    mine = sentencepiece_fst.compile_model()
    for text in ((run * 20_000)[:20_000], "a " + (run * 5000)[:5000] + " b"):
        ids = mine.encode(text)
        assert ids == theirs.encode(text)
        assert mine.decode(ids) == text


def test_sentencepiece_of_batches(spark):
    """Nulls, empty texts and slices of a batch, and the ids that Spark returns, are those of each text alone."""
    texts = [None, "", " ", "  a  b ", "a\n\n b", "x▁ y", "日本 é🤗", "\x00", "word " * 50_000, "a", "a"]
    mine = sentencepiece_fst.compile_model()
    whole = pa.array(texts, pa.string())
    for column in (whole, whole.slice(2, 6), pa.chunked_array([whole]).combine_chunks().cast(pa.large_string())):
        borders, ids = mine.encode_batch(column)
        back = mine.decode_batch(borders, ids).to_pylist()
        for k, text in enumerate(column.to_pylist()):
            assert ids[borders[k] : borders[k + 1]].tolist() == mine.encode(text)
            assert back[k] == (text or "").replace("▁", " ")
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("_ids", F.lit("own"))
    for r in sentencepiece_fst.encode(rows, others=["doc_id"]).collect():
        text = texts[r.doc_id]
        assert r._ids == mine.encode(text)
        assert r._back == (None if text is None else text.replace("▁", " "))


def test_sentencepiece_decodes_broken_bytes_as_the_library():
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    mine = sentencepiece_fst.compile_model()
    rng = np.random.default_rng(8)
    for _ in range(300):
        ids = [int(i) for i in rng.choice([*range(1, 259), 300, 5000, 29871], rng.integers(1, 12))]
        assert mine.decode(ids) == theirs.decode(ids)


@pytest.mark.parametrize("rules", [(True, False, True), (True, True, True), (False, True, True), (False, False, True), (True, True, False)])
def test_normaliser_kernels_write_the_machines_tape(rules):
    n = sentencepiece_fst.Normaliser(*rules)
    rng = np.random.default_rng(9)
    texts = ["".join(rng.choice(list("ab  \n▁é"), rng.integers(0, 9))) for _ in range(500)]
    tapes = n.tapes(pa.array(texts)).to_pylist()
    assert [t.replace(" ", "▁") if n.escape else t for t in tapes] == [n.run(t) for t in texts]


def test_tables_and_tries():
    rng = np.random.default_rng(11)
    keys = rng.choice(10**12, 5000, replace=False)
    table = lattice.Table(keys[:2000], np.arange(2000))
    table.put(keys[2000:4000], np.arange(2000, 4000))
    assert table.get(keys).tolist() == [*range(4000), *[-1] * 1000]
    assert lattice.Table(keys[:0], keys[:0]).get(keys[:3]).tolist() == [-1] * 3
    words_ = [b"a", b"ab", b"abc", b"ba", b"c"]
    text = rng.choice(list(b"abc"), 300).astype(np.uint8)
    got = lattice.ByteTrie(words_, list(range(5))).arcs(text, np.arange(300), np.full(300, 300))
    want = {(i, i + len(w), k) for i in range(300) for k, w in enumerate(words_) if text[i : i + len(w)].tobytes() == w}
    assert set(zip(*(x.tolist() for x in got), strict=True)) == want


def test_sentencepiece_searches_alone_as_together():
    mine = sentencepiece_fst.compile_model()
    rng = np.random.default_rng(12)
    texts = ["".join(rng.choice(list("the quickness of日é🤗,.12-"), rng.integers(1, 40))) for _ in range(400)]
    for text in texts:
        tape = mine.normaliser.run(text)
        assert mine.encode(text) == mine.shortest(tape) == mine.part(tape)


def test_unigram_path_is_least():
    pieces, scores = ["<unk>", "▁", "a", "b", "ab", "▁a", "ba", "aba"], [0, -1.0, -1, -1, -1.5, -3, -1.7, -2.0]
    m = sentencepiece_fst.Transducer(pieces, scores, [2, 1, 1, 1, 1, 1, 1, 1], model=sentencepiece_fst.UNIGRAM)
    assert [m.pieces[i] for i in m.encode("ab")] == ["▁", "ab"]

    def least(text):
        return 0.0 if not text else min((least(text[len(p) :]) - s for p, s in zip(pieces[1:], scores[1:], strict=True) if text.startswith(p)), default=float("inf"))

    rng = np.random.default_rng(10)
    for _ in range(200):
        text = "".join(rng.choice(list("ab"), rng.integers(1, 9)))
        ids = m.encode(text)
        assert "".join(m.pieces[i] for i in ids) == "▁" + text
        assert -sum(scores[i] for i in ids) == pytest.approx(least("▁" + text))


def test_near_classes_match_brute_force(spark, odd, none):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    sets = {}
    for r in docs.select("doc_id", "text").collect():
        w = words(r.text)
        sets[r.doc_id] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    top = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    while changed:
        changed = False
        for k, a in enumerate(ids):
            for b in ids[:k]:
                common = len(sets[a] & sets[b])
                if sets[a] and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) and top[a] != top[b]:
                    top[a] = top[b] = min(top[a], top[b])
                    changed = True
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()}
    assert got == top
    seen = [tuple(r) for r in near_dedup.near_classes(odd).collect()]
    assert len(seen) == odd.count()
    assert {c for i, c in seen if i in (4, 5, None)} == {4}
    assert {i: c for i, c in seen if i in (1, 2, 3, 6)} == {1: 1, 2: 2, 3: 3, 6: 6}
    assert near_dedup.near_classes(none).count() == 0


def test_near_copies_with_repeated_passages(spark):
    rows = []
    for pair in range(20):
        own = [f"w{pair}x{k}" for k in range(100)]
        rows += [(2 * pair, " ".join(own)), (2 * pair + 1, " ".join(own[:60] + own[40:60] * 1000 + own[60:]))]
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i // 2 * 2 for i in range(40)}


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 400).astype(np.uint64)
    row, element = np.repeat([0, 1], 300), np.r_[x[:300], x[100:]]
    s = near_dedup.signatures(row, element, np.ones(600), 2, 4096)
    assert (s[0] == s[1]).mean() == pytest.approx(0.5, abs=0.05)


def test_fm_index_finds_all():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 4, 3000)
    text[500:600] = text[100:200]
    text[-1] = 0
    index = fm_index.FMIndex(text, 3)
    for size in (1, 3, 7):
        for at in range(0, 2900, 97):
            phrase = text[at : at + size]
            if (phrase == 0).any():
                continue
            lo, hi = index.search(phrase[None, :].astype(np.int64), np.array([size]))
            want = [i for i in range(len(text) - size + 1) if (text[i : i + size] == phrase).all()]
            assert sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) == want


def test_decontamination(spark, odd, none):
    bench = spark.createDataFrame([(1, "One two three four five six seven eight nine ten eleven"), (12, "Short item"), (None, "x y"), (7, None), (8, "...")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a one, TWO three four five six seven eight nine ten b short ITEM"), (2, "one two three four five six seven eight nine x ten"), (3, None)], "doc_id long, text string")
    for block in (8_000_000, 10):
        got = {r.doc_id: r for r in decontaminate.digest(decontaminate.find_spans(docs, bench, block_bytes=block)).collect()}
        assert (got[1].n_words, got[1].n_hit, got[1].n_items, got[1].contaminated) == (14, 12, 2, True)
        assert got[1].items_sha256 == hashlib.sha256(b"1,12").hexdigest()
        assert (got[2].n_hit, got[3].n_words, got[3].items_sha256) == (0, 0, decontaminate.EMPTY_SHA256)
    assert decontaminate.find_spans(odd, bench).count() == odd.count()
    assert decontaminate.find_spans(none, bench).count() == 0
    assert decontaminate.find_spans(odd, bench.limit(0)).filter(F.size("_spans") > 0).count() == 0


def test_token_counts_are_greedy(odd, none):
    pieces = ["▁a", "▁ab", "b", "bc", "c", "cd", "abc", "▁"]
    machine = token_counts.Automaton(pieces)
    known = set(pieces)

    def greedy(word):
        text, at, n = "▁" + word, 0, 0
        while at < len(text):
            end = next((e for e in range(len(text), at, -1) if text[at:e] in known and (text[at] == "▁") == (at == 0)), None)
            if end is None:
                return 0
            at, n = end, n + 1
        return n

    rng = np.random.default_rng(4)
    for _ in range(2000):
        word = "".join(rng.choice(list("abcd"), rng.integers(1, 9)))
        assert machine.count(word) == greedy(word)
    assert {r.doc_id: r.n_words for r in token_counts.token_counts(odd, pieces).collect()}[3] == 30_000
    assert token_counts.token_counts(none, pieces).count() == 0


def test_license_scan(odd, none):
    s = license_scan.Scanner()
    assert s.scan("Some text.\nReleased under the MIT Licence.\nMore text here")[0] == ["MIT"]
    assert s.scan("intro. Licensed under CC BY-NC 4.0. And more")[0] == ["CC-BY-NC-4.0"]
    assert s.scan("Licensed professionals work here under the law")[0] == []
    for name, text in license_scan.TEMPLATES:
        found = s.scan(text)
        assert found[1] == 1.0
        assert name in found[0]
    assert license_scan.scan_licenses(odd).count() == odd.count()
    assert license_scan.scan_licenses(none).count() == 0


def test_license_query_is_unpruned_dice(spark):
    """Every unit of every text against every template, with no bound and no cache."""

    def pairs(text):
        w = ["license" if x == "licence" else x for x in words(text)]
        return Counter(zip(w, w[1:]))

    templates = [(name, pairs(text)) for name, text in license_scan.TEMPLATES]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op8_license_scan(spark, DATA).collect()}
    assert len(got) == len(docs)
    for r in docs:
        names, top = set(), 0.0
        for unit in set(license_scan.units(r.text)) if r.text else ():
            mine = pairs(unit)
            size = sum(mine.values())
            if not size:
                continue
            scores = [(2 * sum((mine & own).values()) / (size + sum(own.values())), name) for name, own in templates]
            good = [(-d, n) for d, n in scores if d >= license_scan.MIN_DICE]
            if good:
                names.add(min(good)[1])
                top = max(top, -min(good)[0])
        assert got[r.doc_id].licenses == ",".join(sorted(names))
        assert got[r.doc_id].best_dice == pytest.approx(top)


def test_token_count_query_is_greedy(spark):
    """The whole query against longest-match from the left."""
    pieces = set(token_counts.model_pieces())
    longest = max(map(len, pieces))
    got = {r.doc_id: r for r in queries.op7_token_counts(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs[::9]:
        n = unknown = 0
        for word in (r.text or "").split():
            text, at, parts = "▁" + word, 0, 0
            while at < len(text):
                end = next((e for e in range(min(len(text), at + longest), at, -1) if text[at:e] in pieces and (text[at] == "▁") == (at == 0)), None)
                if end is None:
                    parts, unknown = 1, unknown + 1
                    break
                at, parts = end, parts + 1
            n += parts
        assert (got[r.doc_id].n_words, got[r.doc_id].n_tokens, got[r.doc_id].n_unknown) == (len((r.text or "").split()), n, unknown)


def test_exact_search(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 0.3, (400, 8)).astype(np.float32)
    vectors[50:90] = vectors[50]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(1000, None), (1050, [1.0, None]), (1100, [float("nan")] * 8), (1150, [1.0, 2.0]), (1200, [])]
    got = defaultdict(list)
    for r in exact_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    whole = np.floor(256 * vectors.astype(np.float64)).astype(np.int64)
    for q in range(0, 400, 50):
        scores = whole @ whole[q]
        want = sorted((i for i in range(400) if i != q), key=lambda i: (-scores[i], i))[:5]
        assert got[q] == [(i, scores[i]) for i in want]
    assert set(got) == set(range(0, 400, 50))


@pytest.mark.parametrize("block", [16384, 3])
def test_exact_search_by_row(spark, block):
    """Repeated ids, repeated rows and null ids: every row but the query's own is a candidate."""
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 3)]) for i in rng.choice([0, 50, 100, 7, 8, 9], 60)]
    rows += [(50, [9.0, 9.0, 9.0])] * 3 + [(50, [20.0, -20.0, 0.0]), (None, [10.0, 10.0, 10.0]), (None, [0.0, 0.0, 0.0]), (None, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("q", F.lit(1)).withColumn("own", F.lit(1))
    got = sorted((r.query_id, r.rank, -1 if r.vec_id is None else r.vec_id, r.score) for r in exact_search.top_k(frame, query_block=block).collect())
    want = []
    usable = [(i, [int(256 * x // 1) for x in v]) for i, v in rows if v is not None]
    for k, (i, v) in enumerate(usable):
        if i is not None and i % 50 == 0:
            others = [(-sum(a * b for a, b in zip(v, w, strict=True)), j is None, j or 0) for n, (j, w) in enumerate(usable) if n != k]
            want += [(i, r, -1 if null else j, -score) for r, (score, null, j) in enumerate(sorted(others)[:5], 1)]
    assert got == sorted(want)
    assert exact_search.top_k(frame.limit(0)).count() == 0


@pytest.mark.parametrize(("size", "kind"), [(8, "float"), (600, "float"), (8, "double")])
def test_exact_search_of_large_components(spark, size, kind):
    rng = np.random.default_rng(6)
    scale = 10.0 ** rng.integers(0, 36 if kind == "float" else 300, (300, 1))
    scale[:100] = rng.choice([1.0, 16000, 40000, 1e6], (100, 1))
    vectors = rng.normal(0, 1, (300, size)) * scale
    vectors[100:110] = vectors[100]
    vectors[7] = 1.7e308 if kind == "double" else 3e38
    vectors[8] = -vectors[7]
    vectors[9, 0] = np.inf
    vectors = vectors.astype(np.float32).astype(np.float64) if kind == "float" else vectors
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    whole = {i: [int(Fraction(x) * 256 // 1) for x in v] for i, v in rows if np.isfinite(v).all()}
    got = defaultdict(list)
    for r in exact_search.top_k(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>"), every=30).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 300, 30))
    for q, found in got.items():
        scores = {i: sum(a * b for a, b in zip(whole[q], v, strict=True)) for i, v in whole.items() if i != q}
        want = sorted(scores, key=lambda i: (-scores[i], i))[:5]
        assert found == [(i, scores[i] if -(2**63) <= scores[i] < 2**63 else None) for i in want]


def test_sort_key_keeps_order():
    numbers = sorted({s * 2**e + a for s in (-1, 1) for e in (0, 1, 7, 8, 16, 63, 64, 300) for a in (-1, 0, 1)})
    assert sorted(numbers, key=exact_search.sort_key) == numbers


def test_language_gradients_and_accuracy(spark, odd, none):
    rng = np.random.default_rng(0)
    h = language_id.HIDDEN
    m = language_id.Model(["a", "b"], *[rng.normal(0, 0.5, s) for s in ((2, 256, 3 * h), (2, h, 3 * h), (2, h, 2), (2,))])
    w, on, y = rng.integers(0, 256, (3, 7)).astype(np.uint8), np.ones((3, 7)), np.array([0, 1, 1])
    on[1, 5:] = 0
    _, grads = language_id.gradients(m, w, on, y)
    for a, g in zip((m.state, m.out, m.bias), grads[1:], strict=True):
        at, before = tuple(x // 2 for x in a.shape), a[tuple(x // 2 for x in a.shape)]
        a[at] = before + 1e-3
        up = language_id.gradients(m, w, on, y)[0]
        a[at] = before - 1e-3
        assert (up - language_id.gradients(m, w, on, y)[0]) / 2e-3 == pytest.approx(g[at], abs=1e-4, rel=0.02)
        a[at] = before
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs)
    held = language_id.predict(docs, model).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
    assert not any(map(language_id.has_letter, ["", "12 ½ ² ① Ⅷ!", "🤗 。_", "٣"]))
    assert all(map(language_id.has_letter, ["1a", "½é", "日", "ª", "ʰ"]))
    texts = ["", "Der Hund läuft.", "the dog " * 400, "日本語" * 50]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t.encode()) for t in texts])
    p = language_id.pooled(model, data, ends - np.array([len(t.encode()) for t in texts]), ends)
    for k, t in enumerate(texts):
        raw = np.frombuffer(t.encode(), np.uint8)
        total = np.zeros(len(model.languages))
        for a in range(0, len(raw), language_id.WINDOW):
            w = raw[a : a + language_id.WINDOW][None, :]
            z = language_id._forward(model, w, np.ones(w.shape, bool))[:, 0, :].astype(np.float64)
            z = np.exp(z - z.max(1, keepdims=True))
            total += (z / z.sum(1, keepdims=True))[language_id.POOLED[w[0]]].sum(0)
        assert p[k] == pytest.approx(total / max(1, language_id.POOLED[raw].sum()), abs=1e-3)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(odd, model).collect()}
    assert got[1] == got[2] == got[6] == ("und", 0.0)
    assert language_id.predict(odd, language_id.train(none)).filter("lang_pred <> 'und'").count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), con.execute(queries.SQL[name]).df()
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    assert sorted(map(str, got[order].values.tolist())) == sorted(map(str, want[order].values.tolist()))
