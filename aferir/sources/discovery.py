"""Find the source files of every year under ``<root>/<dataset>/<year>/``."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.sources.tables import SOURCE_YEAR, file_name


@dataclass(frozen=True)
class SourceFile:
    year: int
    path: str
    modified: datetime


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and modification time of every file below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", F.col("modificationTime").alias("modificado"))
    )


def find_files(
    spark: SparkSession, root: str, dataset: str, name: str, years: Iterable[int]
) -> list[SourceFile]:
    """Files of the dataset in the given years whose name matches the pattern, whole and caseless.

    The list has a few files per year, so it is small enough for the driver.
    """
    try:
        listed = list_files(spark, f"{root.rstrip('/')}/{dataset}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no folder for {dataset} below {root}") from error
        raise
    year = F.regexp_extract("path", rf"/{re.escape(dataset)}/(\d{{4}})/", 1)
    wanted = listed.withColumn(SOURCE_YEAR, year.try_cast("int")).where(
        F.col(SOURCE_YEAR).isin(*years)
        & F.regexp_extract("path", "([^/]*)$", 1).rlike(rf"(?iu)^(?:{name})\z")
    )
    return [
        SourceFile(r[SOURCE_YEAR], r.path, r.modificado) for r in wanted.orderBy("path").collect()
    ]


def one_per_year(files: Iterable[SourceFile]) -> dict[int, SourceFile]:
    """One file per year: names that carry the year first, xlsx before other suffixes, then by path."""

    def preference(f: SourceFile):
        name = file_name(f.path)
        return (str(f.year) not in name, not name.lower().endswith(".xlsx"), f.path)

    chosen: dict[int, SourceFile] = {}
    for f in sorted(files, key=preference):
        chosen.setdefault(f.year, f)
    return dict(sorted(chosen.items()))


def source_manifest(spark: SparkSession, files: Iterable[SourceFile]) -> DataFrame:
    """Year and modification time of the chosen sources."""
    return spark.createDataFrame([(f.year, f.modified) for f in files], "ano int, modificado timestamp")


def output_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """Year and modification time of the written files of a cleaned table, None before any write."""
    try:
        listed = list_files(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    year = F.regexp_extract("path", rf"/{SOURCE_YEAR}=(\d+)/", 1).try_cast("int")
    return listed.select(year.alias("ano"), "modificado").where("ano IS NOT NULL")
