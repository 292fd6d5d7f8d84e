"""Exact top-k search with vector-approximation files.

Vectors become integers, floor(256 x). Each block of vectors has an approximation: the cell of every component on a grid of
``CELLS`` cells. A query's scan of the cells bounds its score with each vector from both sides. Exact vectors are then read in order of
their upper bound until the k-th best exact score is above all that are left.

Vectors whose scores a float64 sum may not hold exactly, as queries or as candidates, are bounded by that sum with its rounding error
instead, and their exact scores are sums of Python integers.

Queries go in blocks of at most ``QUERY_BLOCK`` rows, one pass over all vectors each: a block's broadcast has that bound and goes when
its pass is over, and with more than one block each pass is written to the shared folder, so that neither the plan nor the driver
grows with the queries. A task keeps the k + 1 best of its partition for each query, and these few are merged by query.

A row isn't its own partner, but other rows of its id are. Rows of the same id and vector are one query with so many copies; of the k + 1
best rows one that looks like the query itself is left out, and it doesn't matter which of those that look alike it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from math import inf, isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint_dir, cut

K = 5
EVERY = 50
SCALE = 256
CELLS = 16
#: Vectors that are bounded at once; queries that share a broadcast, and those that are bounded at once.
BLOCK = 1024
QUERY_BLOCK = 16384
QUERIES_AT_ONCE = 1024
#: Stands for a null id, which comes last among equal scores.
NO_ID = (1 << 63) - 1
#: Vectors with a scaled component of this size go by Python integers, as do smaller ones that are long, so that scores are exact.
LARGEST = 1 << 22
#: From this size on components are whole numbers, and scaling could overflow.
WHOLE = 2.0**44


class CellFile:
    """The approximation of a block of integer vectors (n, d)."""

    def __init__(self, vectors: np.ndarray, cells: int = CELLS):
        low, high = vectors.min(0).astype(np.float64), vectors.max(0).astype(np.float64)
        self.width = np.maximum((high - low) / cells, 1e-9)
        self.low = low
        self.codes = np.minimum((vectors - low) / self.width, cells - 1).astype(np.uint8)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (q, n) of the inner products, with room for rounding."""
        middle = self.low + (self.codes + 0.5) * self.width
        centre = queries @ middle.T
        reach = np.abs(queries) @ (self.width / 2)
        slack = 1e-6 * (1 + np.abs(queries) @ np.abs(middle).max(0)) + reach * 1e-9
        return centre - (reach + slack)[:, None], centre + (reach + slack)[:, None]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    return np.lexsort((ids, -scores))[:k]


def sort_key(score: int) -> bytes:
    """Bytes in the order of the integers, of any size."""
    size = (abs(score).bit_length() + 7) // 8
    key = (0x8000 + size).to_bytes(2, "big") + abs(score).to_bytes(size, "big")
    return key if score >= 0 else bytes(255 - b for b in key)


def exact_limit(d: int) -> int:
    """Components below this in size have exact float64 sums of d products."""
    return min(LARGEST, isqrt((1 << 53) // d))


def whole_numbers(row: np.ndarray) -> list[int]:
    """The scaled components of a vector as Python integers."""
    return [int(x * SCALE) if abs(x) < WHOLE else int(x) * SCALE for x in row.tolist()]


def search_large(query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, best_so_far: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Betters what is kept of one query by vectors (not scaled, as the query) of any size."""
    scores, have = best_so_far
    up = np.full(len(ids), inf)
    certain = scores[k - 1] if len(scores) >= k else -inf
    d = len(query)
    # Otherwise the sums could overflow, and all vectors are read.
    if np.frexp(np.abs(query).max())[1] + np.frexp(np.abs(vectors).max())[1] + d.bit_length() < 1000:
        about = (vectors @ query) * SCALE**2
        error = (np.abs(vectors) @ np.abs(query)) * (SCALE**2 * (d + 4) * 2.0**-51)
        low, up = about - error, about + error
        if len(low) > k:
            certain = max(certain, float(np.partition(low, len(low) - k)[len(low) - k]))
    left = np.flatnonzero(up >= as_float(certain))
    left = left[np.argsort(-up[left], kind="stable")]
    while len(left):
        now, left = left[: 8 * k], left[8 * k :]
        found = np.empty(len(now), object)
        found[:] = [exact_score(query, vectors[i]) for i in now]
        scores, have = np.r_[scores.astype(object), found], np.r_[have, ids[now]]
        top = best(scores, have, k)
        scores, have = scores[top], have[top]
        if len(scores) >= k:
            left = left[up[left] >= as_float(scores[k - 1])]
    return scores, have


def exact_score(a: np.ndarray, b: np.ndarray) -> int:
    return sum(x * y for x, y in zip(whole_numbers(a), whole_numbers(b), strict=True))


def as_float(score: float) -> float:
    try:
        return float(score)
    except OverflowError:
        return inf if score > 0 else -inf


def search_block(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, kept: list[tuple[np.ndarray, np.ndarray]], k: int) -> int:
    """Betters kept (scores, ids of each query) by a block; returns how many exact vectors were read."""
    exact = vectors.astype(np.float64)
    floats = queries.astype(np.float64)
    lower, upper = CellFile(vectors).bounds(floats)
    certain = np.array([as_float(s[k - 1]) if len(s) >= k else -np.inf for s, _ in kept])
    if lower.shape[1] > k:
        certain = np.maximum(certain, np.partition(lower, lower.shape[1] - k, axis=1)[:, lower.shape[1] - k])
    read = 0
    # Most blocks hold nothing for most queries, once these have k good partners.
    for q in np.flatnonzero((upper >= certain[:, None]).any(1)).tolist():
        scores, have = kept[q]
        up = upper[q]
        left = np.flatnonzero(up >= certain[q])
        left = left[np.argsort(-up[left], kind="stable")]
        while len(left):
            now, left = left[: 8 * k], left[8 * k :]
            found = (exact[now] @ floats[q]).astype(np.int64)
            read += len(now)
            scores, have = np.r_[scores, found], np.r_[have, ids[now]]
            top = best(scores, have, k)
            scores, have = scores[top], have[top]
            if len(scores) >= k:
                left = left[up[left] >= as_float(scores[k - 1])]
        kept[q] = (scores, have)
    return read


def search_any(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, kept: list[tuple[np.ndarray, np.ndarray]], k: int) -> None:
    """search_block for vectors and queries that aren't scaled yet, of any size."""
    limit = exact_limit(vectors.shape[1]) / SCALE
    few, small = np.abs(queries).max(1) < limit, np.abs(vectors).max(1) < limit
    if small.any():
        mine, block, own = np.flatnonzero(few), (vectors[small] * SCALE).astype(np.int32), ids[small]
        for a in range(0, len(mine), QUERIES_AT_ONCE):
            at = mine[a : a + QUERIES_AT_ONCE]
            better = [kept[q] for q in at]
            search_block((queries[at] * SCALE).astype(np.int32), block, own, better, k)
            for q, found in zip(at.tolist(), better, strict=True):
                kept[q] = found
    large = vectors[~small], ids[~small]
    for q in range(len(queries)) if len(large[1]) else np.flatnonzero(~few).tolist():
        kept[q] = search_large(queries[q], *(large if few[q] else (vectors, ids)), kept[q], k)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id and v (array of double): floor(256 x) / 256 with x as double, which is exact and can't overflow. Left out: null or empty
    vectors, null or non-finite components."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < F.lit(inf)))
    usable = x.isNotNull() & (F.size(x) > 0) & F.coalesce(fine, F.lit(False))
    return vectors.filter(usable).select(F.col(f"`{id_col}`").alias("id"), F.transform(x, lambda c: F.when(F.abs(c) < WHOLE, F.floor(c * SCALE) / float(SCALE)).otherwise(c)).alias("v"))


def _search(ready: DataFrame, mine: list, k: int) -> tuple[DataFrame, object]:
    """The k + 1 best of each partition for the queries of one block, and the block's broadcast."""
    by_length: dict[int, tuple[np.ndarray, ...]] = {}
    for size in sorted({len(r.v) for r in mine}):
        same = [r for r in mine if len(r.v) == size]
        by_length[size] = (np.array([r.q for r in same], np.int64), np.array([r.id for r in same], np.int64), np.array([r.copies for r in same], np.int64), np.array([r.v for r in same], np.float64))
    shared = ready.sparkSession.sparkContext.broadcast(by_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = shared.value
        none = np.zeros(0, np.int64)
        kept = {n: [(none, none)] * len(q[0]) for n, q in blocks.items()}
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                ids = part.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
                lengths = part.column("v").value_lengths().to_numpy(zero_copy_only=False)
                values = part.column("v").flatten().to_numpy()
                borders = np.r_[0, np.cumsum(lengths)]
                for n in np.unique(lengths).tolist():
                    if n in blocks:
                        rows = np.flatnonzero(lengths == n)
                        matrix = values[borders[rows][:, None] + np.arange(n)]
                        search_any(blocks[n][3], matrix, ids[rows], kept[n], k + 1)
        for n, (numbers, query_ids, copies, queries) in blocks.items():
            out: list[tuple] = []
            for q, (scores, ids) in enumerate(kept[n]):
                itself = exact_score(queries[q], queries[q])
                for score, other in zip(scores.tolist(), ids.tolist(), strict=True):
                    own = other == query_ids[q] and score == itself
                    out.append((int(numbers[q]), int(query_ids[q]), int(copies[q]), None if other == NO_ID else other, score if -(1 << 63) <= score < 1 << 63 else None, sort_key(score), own))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["q", "query_id", "copies", "vec_id", "score", "key", "own"])

    rows = ready.select(F.col("id").cast("long").alias("id"), "v")
    return rows.mapInArrow(run, "q long, query_id long, copies long, vec_id long, score long, key binary, own boolean"), shared


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding", query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each row whose id is divisible by ``every``, with every
    row but itself; all, if there are fewer. Ties go to the smaller id, a null id last.

    Rows that repeat an id are queries and candidates each, so an id can have several ranks 1. A row with a null id is a candidate
    only. Vectors of another length than the query's are no candidates for it. All finite vectors count; a score beyond a long is
    null, but ranked exactly. An empty table gives no rows; extra columns are ignored. (An id of 2**63 - 1 is taken for null.)
    """
    spark = vectors.sparkSession
    ready = quantised(vectors, id_col, vector_col)
    kind = ready.schema["id"].dataType.simpleString()
    queries = cut(ready.filter(F.col("id") % every == 0).groupBy("id", "v").agg(F.count("*").alias("copies")))
    blocks = max(1, -(-queries.count() // query_block))
    where = f"{checkpoint_dir(spark)}/exact-search-{uuid.uuid4().hex}"
    for b in range(blocks):
        mine = queries.filter(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)) == b).select(F.col("id").cast("long").alias("id"), "v", "copies").collect()
        numbered = [r + (b << 40 | i,) for i, r in enumerate(sorted(mine))]
        found, shared = _search(ready, [_Query(*r) for r in numbered], k)
        if blocks > 1:
            found.write.mode("append").parquet(where)
            shared.destroy()
    found = spark.read.parquet(where) if blocks > 1 else found
    order = Window.partitionBy("q").orderBy(F.desc("key"), F.asc_nulls_last("vec_id"))
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k + 1)
    itself = F.coalesce(F.min(F.when(F.col("own"), F.col("rank"))).over(Window.partitionBy("q")), F.lit(k + 1))
    top = top.withColumn("itself", itself).filter("rank <> itself").withColumn("rank", F.col("rank") - (F.col("rank") > F.col("itself")).cast("int"))
    shown = top.select(F.explode(F.array_repeat("query_id", F.col("copies").cast("int"))).alias("query_id"), "rank", "vec_id", "score")
    return shown.select(F.col("query_id").cast(kind).alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").cast(kind).alias("vec_id"), "score")


class _Query(NamedTuple):
    id: int
    v: list[float]
    copies: int
    q: int
