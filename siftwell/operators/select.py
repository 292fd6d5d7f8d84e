"""Deduplication, ranking, selection and evidence merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C


def best_per_group(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group; order must end with a key that breaks all ties."""
    return top_per_group(rows, keys, order, 1, "_place").drop("_place")


def top_per_group(rows: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group with their rank. Spark cuts each task's rows to k before the shuffle."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)


def source_weight(source: Column, weights: dict[str, float] = C.ALIAS_SOURCE_WEIGHTS) -> Column:
    found = F.lit(0.0)
    for name, weight in weights.items():
        found = F.when(source == name, weight).otherwise(found)
    return found


def dedupe_aliases(aliases: DataFrame, entity: str, form: str, weight: str, order: list[str]) -> DataFrame:
    """One alias of each entity and form: the heaviest source, then by order."""
    return best_per_group(aliases, [entity, form], [F.desc(weight), *map(F.asc, order)])


def gap_to_next(rows: DataFrame, keys: list[str], score: str, tie: list[str]) -> DataFrame:
    """Adds rank, n_candidates and gap (score minus the next one's; null for the last)."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), *tie)
    return (
        rows.withColumn("rank", F.row_number().over(w))
        .withColumn("gap", F.col(score) - F.lead(score).over(w))
        .withColumn("n_candidates", F.count("*").over(Window.partitionBy(*keys)))
    )


def select_candidates(rows: DataFrame, keys: list[str], score: str, direct: str, tie: list[str], least: float = 0.88, sure: float = 0.96, gap: float = 0.03) -> DataFrame:
    """All direct candidates of a key if it has one; else its best, if that is at least ``least`` and alone, ``sure`` or ahead by ``gap``."""
    ranked = gap_to_next(rows, keys, score, tie).withColumn("_direct", F.max(F.col(direct).cast("int")).over(Window.partitionBy(*keys)))
    top = (F.col("rank") == 1) & (F.col(score) >= least) & ((F.col("n_candidates") == 1) | (F.col(score) >= sure) | (F.col("gap") >= gap))
    return ranked.filter(((F.col("_direct") == 1) & F.col(direct)) | ((F.col("_direct") == 0) & top)).drop("_direct")


def merge_evidence(rows: DataFrame, keys: list[str], score: str, method: str, direct: str, reason: str, seq: str, place: str, most_reasons: int = 8) -> DataFrame:
    """One row of each key: pieces of evidence, best score with the method that reached it first, whether any is direct, distinct
    methods, and the first distinct reasons by ``seq``, the order in which the evidence came. Reasons that came together are in the
    order of their first rows by ``place``, a long that no two rows share. Nulls are last in every order; a null reason is one of the reasons."""
    last = lambda c: [F.col(c).isNull().alias(f"_no_{c}"), F.col(c)]
    first = rows.groupBy(*keys, reason).agg(F.min(seq).alias("_seq"), F.min(place).alias("_place"))
    first = first.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_list(F.struct(*last("_seq"), "_place", reason))), 1, most_reasons).alias("_first"))
    merged = rows.groupBy(*keys).agg(
        F.count("*").alias("n_evidence"),
        F.max(score).alias("best_score"),
        F.min(F.struct(F.col(score).isNull().alias("_no_score"), (-F.col(score)).alias("_s"), *last(seq), *last(method))).getField(method).alias("best_method"),
        F.bool_or(direct).alias("any_direct"),
        F.array_sort(F.collect_set(method)).alias("methods"),
    )
    return merged.join(first.select(*keys, F.col(f"_first.{reason}").alias("reasons")), keys)


def coverage(rows: DataFrame, status: Column) -> DataFrame:
    """status, n and percent of all rows."""
    counts = rows.groupBy(status.alias("status")).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def profile(rows: DataFrame, column: str) -> DataFrame:
    """How often each value occurs; the empty string and null as ``<empty>``."""
    return rows.groupBy(F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("<empty>")).alias("value")).agg(F.count("*").alias("n"))
