"""Higher-education census: institutions (state and staff measures) and courses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.functions import values as V
from aferir.operators import dedup, reshape
from aferir.plans.build import (
    BuildReport,
    bad_casts,
    gate_years,
    missing_columns,
    publish_gold,
    write_passing_years,
    years_to_build,
)
from aferir.schemas import census
from aferir.schemas.layout import Layout
from aferir.session import staged
from aferir.sources.delimited import POSITION, read_years_mapped
from aferir.sources.discovery import find_files, one_per_year
from aferir.sources.tables import SOURCE_YEAR, gold_path, read_years, silver_path

DATASET = "censo-superior"
FILE_ORDER = (SOURCE_YEAR, *POSITION)

# Published columns of the tables below.
HISTORY = (
    "co_ies", "ano", "no_ies", "sg_ies", "tp_categoria_adm", "tp_org_academica", "tp_rede",
    "no_mantenedora", "co_mantenedora", "categoria_adm", "org_academica", "rede",
)
LOCATION = (
    "sg_uf", "no_uf", "co_uf", "co_municipio", "no_municipio", "co_regiao", "no_regiao",
    "in_capital", "co_mesorregiao", "no_mesorregiao", "co_microrregiao", "no_microrregiao",
)


def _sources(
    spark: SparkSession, bronze: str, root: str, years: Sequence[int], force: bool,
    reports: Sequence[BuildReport], file_names: str,
) -> dict[int, str]:
    """Paths of the years that any of the tables needs anew."""
    if min(years) < census.FIRST_YEAR:
        raise ValueError(f"the census has no stable keys before {census.FIRST_YEAR}")
    files = one_per_year(find_files(spark, bronze, DATASET, file_names, years))
    missing = [{SOURCE_YEAR: y, "check": "source_file", "violations": 1} for y in years if y not in files]
    stale: set[int] = set()
    for report in reports:
        report.failures += missing
        if files:
            stale |= set(years_to_build(spark, files.values(), silver_path(root, report.table), force))
    for report in reports:
        report.unchanged = [y for y in files if y not in stale]
    return {y: files[y].path for y in sorted(stale)}


def _write(texts: DataFrame, published, years, root: str, report: BuildReport, layout: Layout, finish=None) -> BuildReport:
    """Gate and write one table of the texts; only its own columns are read."""
    own = texts.select(*layout.columns, *POSITION, SOURCE_YEAR)
    known = {year: names & set(layout.columns) for year, names in published.items()}
    failures = missing_columns(known, lambda year: layout.required)
    failures += gate_years(own, years, layout.keys, bad_casts(layout.types))
    typed = reshape.cast_strict(own, layout.types)
    if finish is not None:
        typed = finish(typed, known)
    return write_passing_years(typed, silver_path(root, report.table), report, years, failures)


def derive_network(typed: DataFrame, published: dict[int, set[str]]) -> DataFrame:
    """Network from the category in the years that do not publish it."""
    lacking = [y for y, names in published.items() if "tp_rede" not in names]
    derived = F.when(F.col(SOURCE_YEAR).isin(*lacking), V.network_of_category(F.col("tp_categoria_adm")))
    return typed.withColumn("tp_rede", derived.otherwise(F.col("tp_rede"))) if lacking else typed


def build_institutions(
    spark: SparkSession, bronze: str, root: str, years: Sequence[int], force: bool = False
) -> list[BuildReport]:
    """Institution state and staff measures of the same files, which are parsed once.

    The columns that either table needs go as text to a staged table by source year; each table is then
    gated and written from its own columns of it, so one may refuse a year that the other takes.
    """
    state, staff = BuildReport("censo_ies"), BuildReport("censo_fact")
    paths = _sources(spark, bronze, root, years, force, [state, staff], r".*IES.*\.csv")
    if not paths:
        return [state, staff]
    institution, measures = census.INSTITUTION, census.STAFF
    headers = {**institution.headers, **measures.headers}
    columns = list(dict.fromkeys([*institution.columns, *measures.columns]))
    texts, published = read_years_mapped(spark, paths, headers, columns, position=True)
    with staged(texts, [SOURCE_YEAR]) as parsed:
        common = (parsed, published, sorted(paths), root)
        return [_write(*common, state, institution, derive_network), _write(*common, staff, measures)]


def build_courses(
    spark: SparkSession, bronze: str, root: str, years: Sequence[int], force: bool = False
) -> BuildReport:
    """Courses; the gates and the write share one parse of the files."""
    report, layout = BuildReport("censo_cursos"), census.COURSE
    paths = _sources(spark, bronze, root, years, force, [report], r".*CURSOS.*\.csv")
    if not paths:
        return report
    texts, published = read_years_mapped(spark, paths, layout.headers, layout.columns, position=True)
    with staged(texts, [SOURCE_YEAR]) as parsed:
        return _write(parsed, published, sorted(paths), root, report, layout)


def decode_labels(df: DataFrame) -> DataFrame:
    decoders = {
        "categoria_adm": ("tp_categoria_adm", census.CATEGORY_LABELS),
        "org_academica": ("tp_org_academica", census.ORGANISATION_LABELS),
        "rede": ("tp_rede", census.NETWORK_LABELS),
    }
    return df.withColumns(
        {
            label: V.decode(F.col(code), labels)
            for label, (code, labels) in decoders.items()
            if code in df.columns
        }
    )


def history(silver: DataFrame) -> DataFrame:
    """hist_ies: attributes that change, one row per institution and year (first published wins)."""
    labelled = decode_labels(silver)
    first = dedup.keep_first(labelled, ["co_ies", "ano"], FILE_ORDER)
    return first.select([c for c in HISTORY if c in first.columns])


def latest_institutions(silver: DataFrame) -> DataFrame:
    """dim_ies: one row per institution with its most recent state, in one pass."""
    latest = dedup.latest_per_key(decode_labels(silver), ["co_ies"], "ano", FILE_ORDER)
    changing = [c for c in HISTORY if c not in ("co_ies", "ano") and c in latest.columns]
    located = [c for c in LOCATION if c in latest.columns]
    picked = latest.select("co_ies", F.col("ano").alias("ano_referencia"), *located, *changing)
    return reshape.suffix_columns(picked, changing, "_atual")


def one_per_key(silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    return dedup.keep_first(silver, keys, FILE_ORDER).drop(*FILE_ORDER)


def publish_institutions(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """hist_ies, dim_ies and fact_censo_ies."""
    silver = read_years(spark, root, "censo_ies")
    staff = one_per_key(read_years(spark, root, "censo_fact"), ["co_ies", "ano"])
    by_year, pk = ["co_ies", "ano"], ["co_ies"]
    return {
        "hist_ies": publish_gold(history(silver), gold_path(root, "hist_ies"), by_year, by_year),
        "dim_ies": publish_gold(latest_institutions(silver), gold_path(root, "dim_ies"), pk, pk),
        "fact_censo_ies": publish_gold(staff, gold_path(root, "fact_censo_ies"), by_year, by_year),
    }


def publish_courses(spark: SparkSession, root: str) -> DataFrame:
    """fact_censo_cursos."""
    keys = ["co_ies", "co_curso", "ano"]
    courses = one_per_key(read_years(spark, root, "censo_cursos"), keys)
    return publish_gold(courses, gold_path(root, "fact_censo_cursos"), keys, ["co_ies", "ano", "co_curso"])
