import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def built(spark, tmp_path_factory):
    """A work folder after the batch build, its metadata, and the fingerprints that went in."""
    from fixture import make

    from siftwell.plans import build
    from siftwell.sources.paths import Paths

    root = make(tmp_path_factory.mktemp("work"))
    fps = spark.createDataFrame([("7", [15, 0]), ("1", [1, 1])], "compound_id string, fp array<long>")
    return Paths(root), build.run(spark, Paths(root), fps), fps
