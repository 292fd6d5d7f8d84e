"""MinHash near-dedup: ProbMinHash signatures of distinct shingles, banding, and exact verification.

Every shingle (five words) is a Poisson process whose rate is its weight: 1 for each, however often it occurs, as links don't count
repeats either. Its arrivals fall on random components of the signature; a component keeps its earliest arrival. A shingle is dropped
as soon as its next arrival is later than every component's (early termination). Two signatures agree in a component with the
probability Jaccard similarity of their documents, which with equal weights is the Jaccard similarity that is checked.

Links are pairs with a Jaccard similarity of 0.8 or more over distinct shingles, checked exactly. Classes are the components of the
links. Pairs of a bucket aren't all listed: first every member is compared with the bucket's most typical one; then only members
that are still apart, with all others of their bucket that are in another class. Pairs already in one class need no check, nor do
pairs whose similarity can't reach 0.8 because of shingles that no other document has (an exact bound).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, U64, cut, hashes_of_rows, mix, slices, text_buffers, word_hashes

SHINGLE = 5
SIMILAR = 0.8
COMPONENTS = 128
BANDS, ROWS = 25, 5
#: Bytes of text that are hashed at once.
CHUNK = 3_000_000


def shingles(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row: row, hash, count. A row of fewer than five words has one shingle of all its words."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    size = np.diff(np.r_[first, len(rows)])
    chained = np.zeros(len(words), U64)
    for k in range(SHINGLE):
        part = words[k:] if k else words
        chained[: len(part)] = mix(chained[: len(part)] * GOLDEN + part)
    long = size >= SHINGLE
    n = np.where(long, size - SHINGLE + 1, 1)
    at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out = chained[at]
    starts = np.cumsum(n) - n
    for i in np.flatnonzero(~long).tolist():
        h = np.zeros(1, U64)
        for w in words[first[i] : first[i] + size[i]]:
            h = mix(h * GOLDEN + w)
        out[starts[i]] = mix(h + U64(int(size[i])))[0]
    for a, b in zip(starts.tolist(), (starts + n).tolist(), strict=True):
        out[a:b].sort()
    row = np.repeat(rows[first], n)
    new = np.flatnonzero(np.r_[True, (out[1:] != out[:-1]) | (row[1:] != row[:-1])])
    return row[new], out[new], np.diff(np.r_[new, len(out)])


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, components: int = COMPONENTS) -> np.ndarray:
    """(n, components): the element of the earliest arrival at each component."""
    earliest = np.full(n * components, np.inf)
    out = np.zeros(n * components, U64)
    many = np.bincount(row, minlength=n)
    # One element alone is the earliest everywhere.
    single = np.flatnonzero(many[row] == 1)
    out.reshape(n, components)[row[single]] = element[single][:, None]
    live = np.flatnonzero(many[row] > 1)
    row, element, weight = row[live], element[live], weight[live]
    time = np.zeros(len(row))
    step = 0
    latest = np.full(n, np.inf)
    while len(row):
        step += 1
        draw = mix(element + U64(step * int(GOLDEN) % (1 << 64)))
        time += -np.log(((draw >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        # The component comes from bits of a second draw, so that it doesn't depend on the waiting time.
        place = row * components + (mix(draw) % U64(components)).astype(np.int64)
        np.minimum.at(earliest, place, time)
        won = earliest[place] == time
        out[place[won]] = element[won]
        rows_now = row[np.r_[True, row[1:] != row[:-1]]]
        latest[rows_now] = earliest.reshape(n, components)[rows_now].max(1)
        on = time < latest[row]
        row, element, weight, time = row[on], element[on], weight[on], time[on]
    return out.reshape(n, components)


def bands_of(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(n, bands) bucket ids; the band's number is part of the id."""
    part = signature[:, : bands * rows].reshape(len(signature), bands, rows)
    h = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U64) * GOLDEN), part.shape[:2])
    for k in range(rows):
        h = mix(h * GOLDEN + part[:, :, k])
    return h.view(np.int64)


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, d1 and d2 (128-bit digest of the word sequence; null without words), n (distinct shingles) and bands."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, begin, end = text_buffers(batch.column("t"))
            for a, b in slices(begin, end, CHUNK):
                n = b - a
                words, rows = word_hashes(data, begin[a:b], end[a:b])
                first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, np.int64)
                place = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)])) if len(rows) else rows
                row, element, _ = shingles(words, rows)
                signature = signatures(row, element, np.ones(len(row)), n)
                buckets = bands_of(signature)
                have = np.bincount(row, minlength=n)
                none = have == 0
                keys = [hashes_of_rows(rows, words, place, n, salt).view(np.int64) for salt in (1, 2)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(buckets.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, n), *(pa.array(k, pa.int64(), mask=none) for k in keys), pa.array(have, pa.int32()), lists], names=["id", "d1", "d2", "n", "bands"]
                )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"id {kind}, d1 long, d2 long, n int, bands array<long>")


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and set: the distinct shingle hashes."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, begin, end = text_buffers(batch.column("t"))
            for a, b in slices(begin, end, CHUNK):
                row, element, _ = shingles(*word_hashes(data, begin[a:b], end[a:b]))
                border = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.ListArray.from_arrays(pa.array(border), pa.array(element.view(np.int64)))], names=["id", "set"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"id {kind}, set array<long>")


def _in_reach(n_a: str, own_a: str, n_b: str, own_b: str) -> Column:
    """Whether SIMILAR is in reach: own shingles (in no other document) are never common, so that at most the smaller rest is."""
    most = F.least(F.col(n_a) - F.col(own_a), F.col(n_b) - F.col(own_b))
    return most >= F.lit(SIMILAR) * (F.col(n_a) + F.col(n_b) - most)


def own_shingles(sets: DataFrame) -> DataFrame:
    """rep and own: how many of its shingles no other set has. Counted with partial sums; a common shingle is one sum."""
    single = sets.select("id", F.explode("set").alias("s")).groupBy("s").agg(F.count("*").alias("k"), F.min("id").alias("rep")).filter("k = 1")
    return single.groupBy("rep").agg(F.count("*").alias("own"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: the pairs whose distinct shingles have a Jaccard similarity of SIMILAR or more."""
    one = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("set_a", "set_b")))
    return both.filter(F.col("common") >= F.lit(SIMILAR) * (F.size("set_a") + F.size("set_b") - F.col("common"))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """id and class (the smallest id of its component) for every id of edges (a, b): large and small stars in turn until no
    edge changes. Every step is an aggregation with partial sums and an equi-join, so a star of any size is spread."""
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    while True:
        for large in (True, False):
            both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else now
            least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
            met = both.join(least, "a")
            if large:
                now = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            else:
                now = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
            now = now.filter("a <> b").distinct()
        now = cut(now)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("id"), F.col("b").alias("class")).union(now.select(F.col("b").alias("id"), F.col("b").alias("class")).distinct())
        before = state


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and class_id (the smallest id of its class) of every row.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. Documents with the same word sequence are copies. Null texts,
    empty texts and texts without words are alone in their class. Rows that repeat an id are in that id's class; a row with a
    null id is in the class of its copies, whose id is null if none of them has one, and has no near copies then.
    """
    made = cut(sketch(docs, id_col, text_col))
    groups = made.filter("d1 is not null").groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    groups = groups.filter("rep is not null")
    members = groups.select("rep", "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("many")).filter("many > 1")
    members = cut(members.join(shared, "bucket"))
    near = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(members.select("rep").distinct(), F.col("_id") == F.col("rep"), "left_semi")
    sets = cut(shingle_sets(near, "_id", "_t").dropDuplicates(["id"]))
    central = members.groupBy("rep").agg(F.sum("many").alias("met")).join(own_shingles(sets), "rep", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    members = cut(members.join(central, "rep"))
    # The hub of a bucket is its most typical member: what others copied from has hardly a shingle of its own.
    typical = (F.col("n") - F.col("own")) / F.col("n")
    hubs = members.groupBy("bucket").agg(F.max(F.struct(typical.alias("typical"), "met", "rep", "n", "own")).alias("hub"))
    hubs = hubs.select("bucket", F.col("hub.rep").alias("a"), F.col("hub.n").alias("n_a"), F.col("hub.own").alias("own_a"))
    pairs = members.join(hubs, "bucket").filter((F.col("rep") != F.col("a")) & _in_reach("n", "own", "n_a", "own_a")).select("a", F.col("rep").alias("b")).distinct()
    links = cut(verified(pairs, sets))
    label = components(links)
    # Buckets that still hold members of several classes: those outside the bucket's main class meet all others.
    placed = members.join(label.withColumnRenamed("id", "rep"), "rep", "left").withColumn("class", F.coalesce("class", "rep"))
    placed = cut(placed.select("bucket", "rep", "n", "own", "class"))
    mixed = placed.groupBy("bucket", "class").agg(F.count("*").alias("k")).groupBy("bucket").agg(F.max(F.struct("k", "class")).alias("main"), F.count("*").alias("classes")).filter("classes > 1")
    sizes = placed.groupBy("bucket").agg(F.min("n").alias("least"))
    left = placed.join(mixed.select("bucket", F.col("main.class").alias("main")), "bucket").join(sizes, "bucket")
    # By its own shingles a document can only link to sets of up to this size; most have no such mate and need no comparison.
    bound = F.col("n") / SIMILAR - F.col("own") * (1 + 1 / SIMILAR)
    left = cut(left.filter(F.col("least") <= bound + 1e-6))
    left = left.join(left.groupBy("rep").agg(F.collect_set("bucket").alias("places")), "rep")
    apart = left.filter("class <> main").select("bucket", F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("own").alias("own_a"), F.col("class").alias("class_a"), F.col("places").alias("places_a"))
    # A pair is made once: in the first bucket that both have, and with the smaller id first where both are apart.
    once = ((F.col("class") == F.col("main")) | (F.col("rep") < F.col("a"))) & (F.array_min(F.array_intersect("places", "places_a")) == F.col("bucket"))
    rest = (
        left.join(apart, "bucket")
        .filter((F.col("class") != F.col("class_a")) & _in_reach("n", "own", "n_a", "own_a") & once)
        .select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b"))
    )
    more = cut(verified(rest, sets))
    if more.isEmpty():
        final = label
    else:
        final = components(links.union(more))
    ids = groups.select("d1", "d2", "rep").join(final.withColumnRenamed("id", "rep"), "rep", "left").select("d1", "d2", F.coalesce("class", "rep").alias("class"))
    return made.select("id", "d1", "d2").join(ids, ["d1", "d2"], "left").select(F.col("id").alias("doc_id"), F.coalesce("class", "id").alias("class_id"))
