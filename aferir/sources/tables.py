"""Parquet tables: the cleaned layer partitioned by source year, the analytic layer one folder each."""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession

from aferir.operators.reshape import where_years

SOURCE_YEAR = "ano_fonte"
#: Folders of a versioned table; Spark's readers skip names that begin like this.
VERSIONS, MANIFESTS = "_versoes", "_manifesto"


def silver_path(root: str, indicator: str) -> str:
    return f"{root.rstrip('/')}/silver/{indicator}"


def gold_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/gold/{table}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def manifests(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and version folder of the committed versions of a table, oldest first; a few short files."""
    files, folder = file_system(spark, f"{path.rstrip('/')}/{MANIFESTS}")
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.isdigit():
            stream = files.open(status.getPath())
            try:
                found.append((int(name), bytes(stream.readNBytes(4096)).decode()))
            finally:
                stream.close()
    return sorted(found)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The last committed version of an analytic table; a folder without manifests is read as it is."""
    found = manifests(spark, path)
    return spark.read.parquet(f"{path.rstrip('/')}/{found[-1][1]}" if found else path)


def read_years(
    spark: SparkSession, root: str, indicator: str, years: Iterable[int] | None = None
) -> DataFrame:
    """All source years of a cleaned table, or the listed ones by partition pruning."""
    df = spark.read.parquet(silver_path(root, indicator))
    return df if years is None else where_years(df, years, SOURCE_YEAR)


def file_name(path: str) -> str:
    return PurePosixPath(path).name
