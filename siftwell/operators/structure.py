"""Structures as supplied fingerprints (arrays of 64-bit words) and keys: nearest records, matches within a formula, set similarity.

No fingerprint is made here: tables bring theirs, as they bring InChIKeys and formulas.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from .lineage import checkpoint_dir, cut

#: Queries that share a broadcast, and records that are compared at once.
QUERY_BLOCK, RECORDS_AT_ONCE = 8192, 1024


def _matrix(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints as rows of the widest one's words, and their numbers of bits."""
    size = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), max(1, int(size.max(initial=0)))), np.uint64)
    on = np.arange(out.shape[1]) < size[:, None]
    out[on] = words.flatten().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return out, np.bitwise_count(out).sum(1).astype(np.int64)


def nearest(queries: DataFrame, records: DataFrame, id_col: str, fp_col: str, k: int, least: float) -> DataFrame:
    """query_id, record_id, similarity, rank: the k records of another id with the highest Tanimoto of at least ``least``, ties to
    the smaller id. Rows without id or fingerprint take no part.

    A stated query set against all records: queries go in blocks, a pass over the records each; a task keeps k records of each
    query. With more than one block the passes are written to the shared folder, so that no broadcast outlives its pass.
    """
    spark = records.sparkSession
    asked = cut(queries.filter(F.col(id_col).isNotNull() & F.col(fp_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(fp_col).cast("array<long>").alias("fp")).distinct())
    ready = records.filter(F.col(id_col).isNotNull() & F.col(fp_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(fp_col).cast("array<long>").alias("fp"))
    kind = records.schema[id_col].dataType
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    where = f"{checkpoint_dir(spark)}/nearest-{uuid.uuid4().hex}"
    for b in range(blocks):
        mine = sorted(asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect())
        ids = [r.id for r in mine]
        words, bits = _matrix(pa.array([r.fp for r in mine], pa.list_(pa.int64())))
        shared = spark.sparkContext.broadcast((ids, words, bits))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, words, bits = shared.value
            kept: list[list[tuple[float, str]]] = [[] for _ in ids]
            floor = np.full(len(ids), least)
            for batch in batches:
                for a in range(0, batch.num_rows, RECORDS_AT_ONCE):
                    part = batch.slice(a, RECORDS_AT_ONCE)
                    own, n_own = _matrix(part.column("fp"))
                    names = part.column("id").to_pylist()
                    common = np.zeros((len(ids), len(names)), np.int64)
                    for w in range(min(own.shape[1], words.shape[1])):
                        common += np.bitwise_count(words[:, w, None] & own[None, :, w])
                    either = bits[:, None] + n_own[None, :] - common
                    likeness = np.divide(common, either, out=np.zeros(common.shape), where=either > 0)
                    for q in np.flatnonzero((likeness >= floor[:, None]).any(1)).tolist():
                        near = np.flatnonzero(likeness[q] >= floor[q]).tolist()
                        found = kept[q] + [(-float(likeness[q, i]), names[i]) for i in near if names[i] != ids[q]]
                        kept[q] = sorted(found, key=lambda x: (x[0], len(x[1]), x[1]) if numeric else x)[:k]
                        if len(kept[q]) == k:
                            floor[q] = max(least, -kept[q][-1][0])
            out = [(ids[q], name, -s) for q, found in enumerate(kept) for s, name in found]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["query_id", "record_id", "similarity"])

        numeric = kind.typeName() != "string"
        found = ready.mapInArrow(run, "query_id string, record_id string, similarity double")
        if blocks > 1:
            found.write.mode("append").parquet(where)
            shared.destroy()
    found = spark.read.parquet(where) if blocks > 1 else found
    typed = found.select(F.col("query_id").cast(kind).alias("query_id"), F.col("record_id").cast(kind).alias("record_id"), "similarity").distinct()
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "record_id")
    return typed.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def best_of_formula(left: DataFrame, right: DataFrame, least: float = 0.85) -> DataFrame:
    """compound_id, record_id, similarity: of each row of left (compound_id, formula_key, fp) the row of right (record_id,
    formula_key, fp) of the same formula with the highest Tanimoto of at least ``least``, ties to the smaller record. An equi-join on
    the formula; fingerprints of fewer bits than ``least`` of the other's are out before they are compared."""
    bits = lambda fp: F.aggregate(F.transform(fp, F.bit_count), F.lit(0), lambda a, x: a + x)
    a = left.filter("formula_key <> '' and fp is not null").select("compound_id", "formula_key", F.col("fp").alias("fp_a")).withColumn("bits_a", bits(F.col("fp_a")))
    b = right.filter("formula_key <> '' and fp is not null").select("record_id", "formula_key", F.col("fp").alias("fp_b")).withColumn("bits_b", bits(F.col("fp_b")))
    near = a.join(b, "formula_key").filter(F.least("bits_a", "bits_b") >= least * F.greatest("bits_a", "bits_b"))
    scored = near.withColumn("similarity", sim.tanimoto(F.col("fp_a"), F.col("fp_b"))).filter(F.col("similarity") >= least)
    return scored.groupBy("compound_id").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "record_id")).alias("best")).select("compound_id", F.col("best.record_id").alias("record_id"), (-F.col("best.s")).alias("similarity"))


def pairwise_similarity(members: DataFrame, fingerprints: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_pairs, mean, most, least of the Tanimoto of all pairs of each set. members: keys and member; fingerprints: member and fp.

    Pairs are what is asked for; sets are those of one query's compounds, so they are small.
    """
    rows = members.distinct().join(fingerprints.filter("fp is not null").select("member", "fp"), "member")
    one, two = rows.withColumnsRenamed({"member": "a", "fp": "fp_a"}), rows.withColumnsRenamed({"member": "b", "fp": "fp_b"})
    pairs = one.join(two, keys).filter("a < b").withColumn("s", sim.tanimoto(F.col("fp_a"), F.col("fp_b")))
    return pairs.groupBy(*keys).agg(F.count("*").alias("n_pairs"), F.avg("s").alias("mean"), F.max("s").alias("most"), F.min("s").alias("least"))
