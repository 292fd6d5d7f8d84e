"""Tab-separated tables and JSON files, cell by cell as the reference's runtime writes them."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import formatted


def flag(c: Column) -> Column:
    return F.lower(c.cast("string"))


def joined(c: Column, separator: str = ";") -> Column:
    return F.array_join(c, separator)


def quoted(c: Column) -> Column:
    """A cell as the usual writer quotes it: only where it holds a tab, a quote or a line end."""
    return F.when(c.rlike("[\t\"\r\n]"), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def cells(rows: DataFrame, columns: list[str], formats: dict[str, str | Column] | None = None) -> DataFrame:
    """The columns as text in their order. formats: a number's format, or the cell's expression; booleans are true and false in lower
    case, arrays are joined by semicolons, nulls are empty."""
    formats = formats or {}
    out = []
    for name in columns:
        how = formats.get(name)
        if isinstance(how, str):
            cell = formatted(F.col(name), how)
        elif how is not None:
            cell = how.cast("string")
        elif isinstance(rows.schema[name].dataType, T.ArrayType):
            cell = joined(F.col(name))
        else:
            cell = F.col(name).cast("string")
        out.append(F.coalesce(cell, F.lit("")).alias(name))
    return rows.select(*out)


def write_tsv(rows: DataFrame, path: str, columns: list[str], order: list[Column] | None = None, formats: dict[str, str | Column] | None = None, headers: dict[str, str] | None = None) -> None:
    """A folder of tab-separated parts, range-partitioned in order, each with the header line, so that any reader of such folders can
    read it back. headers: names to write for columns whose own would clash (Spark takes n and N for the same)."""
    ordered = rows.orderBy(*order) if order else rows
    head = "\t".join((headers or {}).get(c, c) for c in columns)
    lines = cells(ordered, columns, formats).select(F.concat_ws("\t", *[quoted(F.col(f"`{c}`")) for c in columns]).alias("value"))

    # An empty table has no partition to write a header, so it borrows one row.
    empty = rows.isEmpty()
    lines = rows.sparkSession.range(1).select(F.lit("").alias("value")) if empty else lines

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([head])], names=["value"])
        for batch in batches:
            if not empty:
                yield pa.RecordBatch.from_arrays([batch.column(0)], names=["value"])

    lines.mapInArrow(with_header, "value string").write.mode("overwrite").text(path)


def write_json(spark: SparkSession, value: object, path: str) -> None:
    """One small JSON document, indented."""
    spark.createDataFrame([(json.dumps(value, indent=2, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)
