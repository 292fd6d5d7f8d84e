"""Readers of the formats that entity catalogues come in. Schemas are declared, never inferred; a missing cell is the empty string."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import resolve as R


def unquoted(c: Column) -> Column:
    """A cell as the usual reader of such tables has it: a leading quoted run loses its quotes, doubled ones inside become one, and
    what follows the run stays. Chemical names that hold quotes elsewhere keep them."""
    run = r'^"((?:[^"]|"")*)"'
    inner = F.replace(F.regexp_extract(c, run, 1), F.lit('""'), F.lit('"'))
    return F.when(c.rlike(run), F.concat(inner, F.regexp_replace(c, run, ""))).otherwise(c)


def line_order() -> Column:
    """A text that sorts rows as their lines stand in their files, however the files were split."""
    meta = F.col("_metadata")
    return F.concat_ws("/", meta["file_name"], F.lpad(meta["file_block_start"].cast("string"), 20, "0"), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))


def tsv(spark: SparkSession, path: str, required: list[str], optional: list[str] | None = None) -> DataFrame:
    """The named columns of tab-separated text with a header, plain or gzip, as text, and ``_seq``, the order of lines. Columns are
    found by name; a missing optional one and a missing cell are the empty string."""
    raw = spark.read.csv(path, sep="\t", header=True, quote="", escape="", inferSchema=False)
    absent = [c for c in required if c not in raw.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    cell = lambda c: unquoted(F.coalesce(F.col(f"`{c}`"), F.lit(""))) if c in raw.columns else F.lit("")
    return raw.select(*[cell(c).alias(c) for c in [*required, *(optional or [])]], line_order().alias("_seq"))


def listing(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Tab-separated text without a header: the named columns, the last of them with all that follows, and ``_seq``."""
    parts = F.split("value", "\t", len(columns))
    rows = spark.read.text(path).select("value", line_order().alias("_seq"))
    return rows.select(*[F.coalesce(F.get(parts, F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)], "_seq")


def hierarchy(spark: SparkSession, path: str) -> DataFrame:
    """pathway_id, group, category, name from an indented listing: A group, B category, C id and name."""
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\n")).alias("line", "text"))
    rest = F.trim(F.expr("substring(text, 2)"))
    kept, inner = F.when(F.col("text").startswith("A"), rest), F.when(F.col("text").startswith("B"), rest)
    filled = R.forward_fill(lines, "line", {"group": kept, "category": inner}, ["file"])
    leaf = r"^C\s+(\d{5})\s+(.*)$"
    return filled.filter(F.col("text").rlike(leaf)).select(F.regexp_extract("text", leaf, 1).alias("pathway_id"), "group", "category", F.trim(F.regexp_extract("text", leaf, 2)).alias("name"))


def obo_terms(spark: SparkSession, path: str, namespace: str = "biological_process") -> DataFrame:
    """id and name of the terms of a namespace; a stanza is a record."""
    stanzas = spark.read.text(path, lineSep="\n\n").filter(F.col("value").contains("[Term]"))
    get = lambda tag: F.regexp_extract("value", rf"(?m)^{tag}: (.*)$", 1)
    return stanzas.filter(get("namespace") == namespace).select(get("id").alias("go_id"), get("name").alias("name")).filter("go_id <> ''")


def gaf_processes(spark: SparkSession, path: str) -> DataFrame:
    """gene_id and go_id of biological processes, without negated annotations."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).filter(~F.col("value").startswith("!") & (F.size(f) >= 11))
    negated = F.exists(F.split(F.get(f, F.lit(3)), r"\|"), lambda q: F.upper(F.trim(q)) == "NOT")
    rows = rows.filter((F.get(f, F.lit(8)) == "P") & F.get(f, F.lit(4)).rlike(r"^GO:\d{7}$") & ~negated)
    return rows.select(F.explode(T.loci(F.get(f, F.lit(1)), F.get(f, F.lit(2)), F.get(f, F.lit(9)), F.get(f, F.lit(10)))).alias("gene_id"), F.get(f, F.lit(4)).alias("go_id")).distinct()


def sdf(spark: SparkSession, path: str) -> DataFrame:
    """tags (a map) of each record of SDF files. Text files are split at record ends by Spark; the first member of a zip is streamed."""
    if not path.endswith(".zip"):
        records = spark.read.text(path, lineSep="$$$$\n").select(F.col("value").alias("record"))
    else:

        def members(batches: Iterator) -> Iterator:
            import pandas as pd

            for batch in batches:
                for content in batch["content"]:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for name in z.namelist()[:1]:
                            held: list[str] = []
                            with z.open(name) as lines:
                                for line in io.TextIOWrapper(lines, "utf-8", errors="replace"):
                                    if line.startswith("$$$$"):
                                        yield pd.DataFrame({"record": ["".join(held)]})
                                        held = []
                                    else:
                                        held.append(line)
                            if held:
                                yield pd.DataFrame({"record": ["".join(held)]})

        records = spark.read.format("binaryFile").load(path).select("content").mapInPandas(members, "record string")
    found = F.regexp_extract_all("record", F.lit(r"(?m)^> <[^\n]+>\n(?:[^\n]+\n?)*"), F.lit(0))
    entry = lambda x: F.struct(F.regexp_extract(x, "^> <([^\n]+)>", 1).alias("key"), F.trim(F.regexp_replace(x, r"^[^\n]*\n|\n$", "")).alias("value"))
    return records.filter(F.size(found) > 0).select(F.map_from_entries(F.transform(found, entry)).alias("tags"))


def link_pairs(rows: DataFrame, key: str, links: str) -> DataFrame:
    """key, prefix, value from a field of ``PREFIX:value`` items."""
    item = F.explode(T.split_multi(F.col(links))).alias("item")
    return rows.select(key, item).select(key, F.upper(F.substring_index("item", ":", 1)).alias("prefix"), F.trim(F.regexp_replace("item", "^[^:]*:", "")).alias("value")).filter("value <> '' and item like '%:%'")
