"""Commands: ``python -m siftwell COMMAND --workdir DIR``. No prompts; a session comes from the environment's own configuration."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .sources.paths import Paths, exists


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siftwell", description="Names to compounds, records and pathways.")
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, text: str) -> argparse.ArgumentParser:
        one = commands.add_parser(name, help=text)
        one.add_argument("--workdir", required=True)
        return one

    add("build", "standardise, match, link, annotate, score and write").add_argument("--blank-reactome", action="store_true", help="as versions that never find a Reactome pathway")
    add("align", "align KEGG pathways with AraCyc's").add_argument("--top-k", type=int, default=5)
    add("kegg", "map compounds to KEGG and score its pathways")
    add("recall", "score pathways of related records")
    add("train", "publish a reranking model of all compounds").add_argument("--max-subsets", type=int, default=50)
    ask = add("query", "answer one query, or every line of a file")
    ask.add_argument("-q", "--query")
    ask.add_argument("--input")
    ask.add_argument("--top-k", type=int, default=10)
    ask.add_argument("--no-fuzzy", action="store_true")
    sets = add("enrich", "enriched pathways of a file of names")
    sets.add_argument("--input", required=True)
    sets.add_argument("--out-prefix")
    sets.add_argument("--no-fuzzy", action="store_true")
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("siftwell").getOrCreate()
    paths = Paths(a.workdir.rstrip("/"))
    from .plans import align, build, kegg, query, recall, training
    from .sources import catalog

    model_folder = f"{paths.workdir}/outputs/onlineModels/compound_set_pathway_rerank"
    if a.command == "build":
        print(build.run(spark, paths, blank_reactome=a.blank_reactome))
    elif a.command == "align":
        print(align.summary(align.run(spark, paths, max(1, a.top_k))).first().asDict())
    elif a.command == "kegg":
        kegg.run(spark, paths, build.load(spark, paths)).write.mode("overwrite").parquet(paths.index("stages/kegg_pathways"))
    elif a.command == "recall":
        files = lambda kind: [(db, paths.pmn(spark, f"{db.lower()}_{kind}")) for db in ("AraCyc", "PlantCyc") if exists(spark, paths.pmn(spark, f"{db.lower()}_{kind}"))]
        stats, reactome = catalog.pmn_pathway_stats(spark, files("pathways")), paths.ref("plant_reactome_pathways.tsv")
        names = catalog.plant_reactome_pathways(spark, reactome) if exists(spark, reactome) else None
        print(recall.run(paths, build.load(spark, paths), build.stage(spark, paths, "ranked"), catalog.pmn_details(spark, files("compounds")), stats, catalog.pmn_pathway_ecs(spark, files("pathways")), names))
    elif a.command == "train":
        training.publish(query.Engine.load(spark, paths), model_folder, a.max_subsets)
    elif a.command == "query":
        asked = catalog.name_list(spark, a.input).select(F.col("input_order").alias("qid"), F.col("input_name").alias("query")) if a.input else spark.createDataFrame([(1, a.query or "")], "qid int, query string")
        for row in query.Engine.load(spark, paths).query(asked, a.top_k, a.no_fuzzy).orderBy("qid").toLocalIterator():
            print(query.show(row, a.top_k))
    else:
        engine = query.Engine.load(spark, paths)
        model, why = training.load(spark, model_folder)
        inputs, rows = engine.enrich(catalog.name_list(spark, a.input), no_fuzzy=a.no_fuzzy, rerank=training.reranker(model) if model else None)
        rows = rows if model else rows.withColumn("rerank_reason", F.when(F.col("rerank_reason") == "online_model_missing", why).otherwise(F.col("rerank_reason")))
        stem = a.input.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        query.write_set_query(engine, inputs, rows, a.out_prefix or f"{paths.workdir}/outputs/enrichment/{stem}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
