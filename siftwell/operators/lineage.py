"""Cutting the lineage of iterative plans."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Where none is named, a local master gets a folder of its own; elsewhere that would
    be out of other machines' reach, so it is an error."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="siftwell-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage through the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()
