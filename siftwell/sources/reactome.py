"""Plant Reactome snapshots: JSON as its service answers, already on disk, to the two tables that the engine reads."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sinks import tables as W
from .catalog import REACTOME_COLUMNS


def identifiers(document: Column) -> Column:
    """Gene loci among the values of every ``identifier`` key of a JSON text, at any depth."""
    values = F.regexp_extract_all(document, F.lit(r'"identifier"\s*:\s*"((?:[^"\\]|\\.)*)"'), F.lit(1))
    return T.loci(F.array_join(values, " "))


def flattened(documents: DataFrame, column: str = "value") -> DataFrame:
    """pathway_id, pathway_name, species, top_level_category of all pathways in hierarchy documents of any depth; a repeated id is its
    last occurrence. Children stand under the nearest top-level pathway above them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch[column]:
                rows: dict[str, tuple] = {}
                stack = [(node, "") for node in reversed(json.loads(text) or [])]
                while stack:
                    node, top = stack.pop()
                    name, kind = node.get("name") or node.get("displayName") or "", node.get("type") or node.get("className") or ""
                    top = name if kind == "TopLevelPathway" else top
                    key = node.get("stId", "")
                    if key and kind in ("TopLevelPathway", "Pathway"):
                        rows.pop(key, None)
                        rows[key] = (key, name, node.get("species") or node.get("speciesName") or "", top)
                    stack += [(child, top) for child in reversed(node.get("children") or [])]
                yield pd.DataFrame(list(rows.values()), columns=["pathway_id", "pathway_name", "species", "top_level_category"])

    return documents.select(column).mapInPandas(run, "pathway_id string, pathway_name string, species string, top_level_category string")


def snapshot(hierarchy: DataFrame, details: DataFrame, participants: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The table of pathways and that of their genes. hierarchy: value; details, participants: pathway_id and value (JSON texts)."""
    get = lambda path: F.coalesce(F.get_json_object("value", path), F.lit(""))
    text = lambda c: F.coalesce(T.clean_markup(c), F.lit(""))
    more = details.select(
        "pathway_id", get("$.displayName").alias("n"), get("$.speciesName").alias("s"), get("$.releaseDate").alias("release_date"), get("$.goBiologicalProcess.accession").alias("go_biological_process_id"),
        get("$.goBiologicalProcess.displayName").alias("go_biological_process_name"), F.coalesce(T.missing(text(get("$.summation[0].text"))), text(get("$.goBiologicalProcess.definition"))).alias("description"),
    )
    rows = flattened(hierarchy).join(more, "pathway_id", "left").fillna("")
    rows = rows.withColumns({"pathway_name": F.coalesce(T.missing(F.col("n")), F.col("pathway_name")), "species": F.coalesce(T.missing(F.col("s")), F.col("species"))})
    rows = rows.withColumn("v", T.variants(F.col("pathway_name"))).withColumns({"name_normalized": F.col("v.exact"), "name_compact": F.col("v.compact")})
    genes = participants.select("pathway_id", F.explode(identifiers(F.col("value"))).alias("gene_id"))
    return rows.select(*REACTOME_COLUMNS), genes


def write(pathways: DataFrame, genes: DataFrame, folder: str) -> None:
    W.write_tsv(pathways, f"{folder}/plant_reactome_pathways.tsv", REACTOME_COLUMNS, [F.asc("pathway_id")])
    W.write_tsv(genes, f"{folder}/plant_reactome_gene_pathway.tsv", ["pathway_id", "gene_id"], [F.asc("pathway_id"), F.asc("gene_id")])
    counts = pathways.agg(F.count("*").alias("n"), F.array_sort(F.collect_set(T.missing(F.col("release_date")))).alias("dates")).first()
    newest = counts.dates[-1] if counts.dates else ""
    stamp = "-".join("".join(c if c.isalnum() else " " for c in newest.lower()).split())
    W.write_json(pathways.sparkSession, {"source": "snapshot", "release_dates": counts.dates, "pathway_count": counts.n, "gene_link_count": genes.count(), "vstamp": f"plant_reactome_{stamp}"}, f"{folder}/plant_reactome_version.txt")
