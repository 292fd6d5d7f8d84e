"""Where an engine's tables are, on any file system that Spark reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


def _files(spark: SparkSession, pattern: str) -> list[tuple[str, bool]]:
    """(path, is a file) of what matches a pattern, by the session's own file systems."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [(s.getPath().toString(), s.isFile()) for s in found or []]


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_files(spark, path))


def require(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        if not exists(spark, path):
            raise FileNotFoundError(f"Missing required file: {path}")


def latest(spark: SparkSession, folder: str, prefix: str, fallback: str) -> str:
    """The file ``prefix.NNN`` whose name comes last among those with a suffix of digits; else the fallback's path."""
    versions = [p for p, is_file in _files(spark, f"{folder}/{prefix}.*") if is_file and p.rsplit("/", 1)[-1][len(prefix) + 1 :].isdigit()]
    return max(versions, key=lambda p: p.rsplit("/", 1)[-1], default=f"{folder}/{fallback}")


@dataclass(frozen=True)
class Paths:
    """The files of a work folder. Each name is a property's; a subclass may place them elsewhere."""

    workdir: str

    @property
    def refs(self) -> str:
        return f"{self.workdir}/refs"

    @property
    def preprocessed(self) -> str:
        return f"{self.workdir}/outputs/preprocessed"

    @property
    def tables(self) -> str:
        return f"{self.workdir}/outputs/pathwayTables"

    def ref(self, name: str) -> str:
        return f"{self.refs}/{name}"

    def index(self, name: str) -> str:
        return f"{self.preprocessed}/{name}"

    def pmn(self, spark: SparkSession, name: str) -> str:
        """An export of the plant metabolic network: aracyc_compounds, plantcyc_pathways and so on, the newest version."""
        return latest(spark, self.refs, name, name)

    def required(self, spark: SparkSession) -> list[str]:
        refs = ("names.tsv.gz", "database_accession.tsv.gz", "chemical_data.tsv.gz", "structures.tsv.gz", "lmsd_extended.sdf.zip", "pubchem_cid_synonym_filtered.gz")
        pmn = ("aracyc_compounds", "plantcyc_compounds", "aracyc_pathways")
        return [f"{self.workdir}/compounds.tsv", f"{self.workdir}/comments.tsv", *map(self.ref, refs), *(self.pmn(spark, p) for p in pmn)]

    def check(self, spark: SparkSession) -> None:
        require(spark, *self.required(spark))
