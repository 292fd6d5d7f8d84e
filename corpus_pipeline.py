"""The corpus pipeline: five stages over ``documents``, each calling one operator of ``siftwell.llm``.

Each stage works on all that the one before kept. All but the last return the columns of documents (as they came, extra ones too,
whatever their names: a row travels as one struct beside what the operator reads). Every stage takes empty tables, texts of any
length, nulls in any column and repeated rows; rows that repeat an id are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import decontaminate, language_id, line_dedup, near_dedup, sentencepiece_fst
from siftwell.llm.common import cut, table

#: A document stays if its language's probability is this far from chance, 1 / languages, on the way to certainty.
SURE = 0.2


def _rows(docs: DataFrame) -> F.Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is null or has no letter, or whose language is hardly likelier than chance, go. A null id or language
    doesn't matter. Where no language can be learned, every document goes."""
    model = language_id.train(docs)
    chance = 1 / max(1, len(model.languages))
    verdict = language_id.predict(docs.select(_rows(docs), "doc_id", "text"), model, keep=["row"])
    return verdict.filter((F.col("lang_pred") != "und") & (F.col("score") >= chance + SURE * (1 - chance) - 1e-9)).select("row.*")


def by_line(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go from all but one; documents stay. Null texts stay null; rows without an id lose nothing."""
    return line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs.select("doc_id", "text")), dropped=None)


def by_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id stays. Rows without an id, and texts without a word, stay."""
    lost = near_dedup.near_classes(docs.select("doc_id", "text")).filter("doc_id <> class_id").select(F.col("doc_id").alias("id"))
    return docs.select(_rows(docs), F.col("doc_id").alias("id")).join(lost, "id", "left_anti").select("row.*")


def by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go; null and empty texts have none."""
    found = decontaminate.find_spans(docs.select(_rows(docs), "text"), table(spark, sf_dir, "benchmark"), keep=["row"])
    return found.filter(F.size("_spans") == 0).select("row.*")


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_ids, ids and whether they decode to the text. A null text has no ids and decodes to null."""
    done = sentencepiece_fst.encode(docs.select("doc_id", "lang", "source", F.xxhash64("text").alias("sent"), "text"))
    return done.select("doc_id", "lang", "source", F.size("_ids").cast("long").alias("n_ids"), F.col("_ids").alias("ids"), (F.xxhash64("_back") == F.col("sent")).alias("round_trip"))


STAGES = [
    ("language_id", by_language),
    ("line_dedup", by_line),
    ("near_dedup", by_near_copy),
    ("decontaminate", by_benchmark),
    ("sentencepiece", to_pieces),
]

#: Recurrent networks, near-copy classes and piece ids have no SQL; tests/llm/test_pipeline.py holds each stage to plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
