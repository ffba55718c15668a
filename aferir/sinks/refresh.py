"""Writers and the refresh of years whose sources changed."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.sources.tables import MANIFESTS, SOURCE_YEAR, VERSIONS, file_system, manifests


def stale_years(
    sources: DataFrame, outputs: DataFrame | None, force: bool = False, year: str = "ano"
) -> DataFrame:
    """Years to rebuild: without output, or with any source newer than the output.

    Both manifests have one or more rows (year, ``modificado``); the newest source and the oldest
    output of a year count.
    """
    newest = sources.groupBy(year).agg(F.max("modificado").alias("_source"))
    if force or outputs is None:
        return newest.select(year)
    oldest = outputs.groupBy(year).agg(F.min("modificado").alias("_output"))
    joined = newest.join(oldest, year, "left")
    return joined.where(F.col("_output").isNull() | (F.col("_source") > F.col("_output"))).select(year)


def write_silver(df: DataFrame, path: str, replace_years: Iterable[int] | None = None) -> None:
    """Write cleaned rows by source year; only the years in ``df`` are replaced.

    The rebalance hint lets adaptive execution merge small and split large years into files of the
    advisory size.
    """
    if replace_years is not None:
        df = df.where(F.col(SOURCE_YEAR).isin(*replace_years))
    (
        df.hint("rebalance", F.col(SOURCE_YEAR))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(SOURCE_YEAR)
        .parquet(path)
    )


def write_gold(df: DataFrame, path: str, keys: Sequence[str], keep: int = 2) -> None:
    """Write an analytic table sorted by its key (range partitions, sorted inside) as a new version.

    The rows go to a folder of their own first; the manifest that names it is written last, so readers
    (``read_table``) see the old version or the new one, never a part, and a write that fails anywhere
    leaves the old one. The last ``keep`` versions stay for readers that have begun; older ones go.
    """
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    version = f"{VERSIONS}/{uuid.uuid4().hex}"
    sorted_rows.write.option("compression", "zstd").parquet(f"{path.rstrip('/')}/{version}")
    commit_version(df.sparkSession, path, version)
    remove_old_versions(df.sparkSession, path, keep)


def commit_version(spark: SparkSession, path: str, version: str) -> None:
    """Name the version that readers follow: a manifest with the next number appears whole, by a rename."""
    files, folder = file_system(spark, f"{path.rstrip('/')}/{MANIFESTS}")
    files.mkdirs(folder)
    number = max([n for n, _ in manifests(spark, path)], default=0) + 1
    fresh = spark._jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
    out = files.create(fresh, False)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    named = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}")
    if files.exists(named) or not files.rename(fresh, named):
        raise OSError(f"another writer committed version {number} of {path}")


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the last ``keep`` committed versions, and what failed writes before them left."""
    found = manifests(spark, path)
    stay = {version for _, version in found[-keep:]}
    files, folder = file_system(spark, f"{path.rstrip('/')}/{VERSIONS}")
    oldest = min((files.getFileStatus(file_system(spark, f"{path}/{v}")[1]).getModificationTime() for v in stay), default=0)
    for status in files.listStatus(folder):
        name = f"{VERSIONS}/{status.getPath().getName()}"
        # A folder that is younger than a committed one may be a write under way.
        if name not in stay and status.getModificationTime() < oldest:
            files.delete(status.getPath(), True)
    for number, version in found[:-keep]:
        files.delete(file_system(spark, f"{path.rstrip('/')}/{MANIFESTS}/{number:012d}")[1], False)


def preview(df: DataFrame, keys: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first n rows in key order: each partition keeps n, no full sort."""
    return df.orderBy(*keys).limit(n)
