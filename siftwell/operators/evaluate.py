"""Splits, sampling and measures of rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut


def folds(rows: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """Adds fold: by a hash of the key, so that equal keys share a fold and no sort is needed."""
    return rows.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), key), F.lit(k)).cast("int"))


def ranked_by(rows: DataFrame, sample: str, score: str, tie: list[str]) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(sample).orderBy(F.desc(score), *tie)))


def rank_metrics(rows: DataFrame, sample: str, score: str, label: str, tie: list[str], at: int = 5, recalls: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    """One row: mean NDCG, reciprocal rank and recalls over samples with a positive label. Ties in score share the mean discount
    of their places in NDCG, and go by tie elsewhere."""
    hit = F.when(F.col("rank") <= at, 1 / F.log2(F.col("rank") + 1)).otherwise(0.0)
    ranked = ranked_by(rows, sample, score, tie).withColumn("_d", hit)
    ideal = F.row_number().over(Window.partitionBy(sample).orderBy(F.desc(label), *tie))
    ranked = ranked.withColumn("_ideal", ideal).withColumn("_share", F.avg("_d").over(Window.partitionBy(sample, score)))
    best = F.sum(F.when(F.col("_ideal") <= at, F.col(label) / F.log2(F.col("_ideal") + 1)).otherwise(0.0))
    positive = F.sum(F.when(F.col(label) > 0, 1).otherwise(0))
    each = ranked.groupBy(sample).agg(
        (F.sum(F.col(label) * F.col("_share")) / best).alias("ndcg"),
        F.max(F.when(F.col(label) > 0, 1 / F.col("rank")).otherwise(0.0)).alias("mrr"),
        positive.alias("_p"),
        *[(F.sum(F.when((F.col(label) > 0) & (F.col("rank") <= k), 1).otherwise(0)) / positive).alias(f"recall_{k}") for k in recalls],
    )
    return each.filter("_p > 0").agg(F.count("*").alias("n_samples"), *[F.avg(c).alias(c) for c in ("ndcg", "mrr", *[f"recall_{k}" for k in recalls])])


def summary(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("least"), F.max(value).alias("most"))


def weighted_mean(rows: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    return rows.groupBy(*keys).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("weighted_mean"))


def leakage(train: DataFrame, test: DataFrame, keys: list[str]) -> DataFrame:
    """One row: distinct keys of either side, of both, and the shared part of the test side."""
    a, b = train.select(*keys).distinct().withColumn("_a", F.lit(1)), test.select(*keys).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, keys, "full")
    row = both.agg(F.count("_a").alias("n_train"), F.count("_b").alias("n_test"), F.sum(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1).otherwise(0)).alias("n_shared"))
    return row.withColumn("shared_ratio", F.when(F.col("n_test") > 0, F.col("n_shared") / F.col("n_test")).otherwise(0.0))


def percentiles(rows: DataFrame, value: str, at: list[float]) -> DataFrame:
    """One row of exact percentiles with linear interpolation; nulls don't count, and all are null if there is no value.

    Distinct values and their counts are range-partitioned; the partitions' totals, one row each, tell which hold the ranks asked
    for, and only these number their values. No task sees more than a partition.
    """
    spark = rows.sparkSession
    counts = rows.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    ranged = cut(counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()))
    sizes = {r.part: r.n for r in ranged.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    total = sum(sizes.values())
    names = [f"p{round(p * 100)}" for p in at]
    if not total:
        return spark.createDataFrame([(None,) * len(at)], ", ".join(f"{n} double" for n in names))
    before, start = {}, 0
    for part in sorted(sizes):
        before[part], start = start, start + sizes[part]
    places = [p * (total - 1) for p in at]
    wanted = sorted({int(x) for x in places} | {min(total - 1, int(x) + 1) for x in places})
    held = [part for part in sizes if any(before[part] <= w < before[part] + sizes[part] for w in wanted)]
    base = F.create_map(*[x for part in held for x in (F.lit(part), F.lit(before[part]))])
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    placed = ranged.filter(F.col("part").isin(held)).withColumn("end", base[F.col("part")] + upto)
    asked = F.array(*[F.lit(w) for w in wanted])
    hits = placed.select("v", F.explode(F.filter(asked, lambda w: (w < F.col("end")) & (w >= F.col("end") - F.col("n")))).alias("w")).collect()
    value_at = {r.w: r.v for r in hits}
    out = [value_at[int(x)] + (value_at[min(total - 1, int(x) + 1)] - value_at[int(x)]) * (x - int(x)) for x in places]
    return spark.createDataFrame([tuple(out)], ", ".join(f"{n} double" for n in names))


def negatives(rows: DataFrame, sample: str, item: str, score: str, label: str, hard: int = 20, total: int = 30, seed: int = 42) -> DataFrame:
    """All positives, the hardest negatives, and a fixed random fill up to total negatives of each sample."""
    w = Window.partitionBy(sample, label)
    ranked = rows.withColumn("_hard", F.row_number().over(w.orderBy(F.desc(score), item)))
    lot = F.when(F.col("_hard") <= hard, F.lit(-(2**63)).cast("long")).otherwise(F.xxhash64(F.lit(seed), sample, item))
    ranked = ranked.withColumn("_place", F.row_number().over(w.orderBy(lot, "_hard")))
    return ranked.filter((F.col(label) > 0) | (F.col("_place") <= total)).drop("_hard", "_place")


def top_labels(contributions: Column, k: int = 3, positive: bool = True) -> Column:
    """Names of the largest (or most negative) entries of a map of contributions."""
    pairs = F.filter(F.map_entries(contributions), lambda e: e["value"] > 0 if positive else e["value"] < 0)
    keyed = F.transform(pairs, lambda e: F.struct((-e["value"] if positive else e["value"]).alias("v"), e["key"].alias("k")))
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda e: e["k"])
