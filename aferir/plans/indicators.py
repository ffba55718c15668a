"""Workbook indicators: course (CPC), difference (IDD) and institution (IGC) grades."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.functions import values as V
from aferir.operators import dedup, reshape
from aferir.operators.lookup import enrich_codes
from aferir.operators.quality import required_for_year
from aferir.plans.build import (
    BuildReport,
    gate_years,
    missing_columns,
    publish_gold,
    write_passing_years,
    years_to_build,
)
from aferir.schemas import sheets
from aferir.schemas.common import YEARS_WITHOUT_EXAM
from aferir.schemas.layout import Layout
from aferir.session import materialise
from aferir.sources.delimited import read_codes_of_years
from aferir.sources.discovery import find_files, one_per_year
from aferir.sources.tables import SOURCE_YEAR, gold_path, read_years, silver_path
from aferir.sources.workbook import read_sheets

SHEET_ORDER = (SOURCE_YEAR, "_linha")
XLSX = r".*\.xlsx"
# Code columns of the exam's course file, by published name.
CODE_COLUMNS = {
    "CO_IES": "co_ies",
    "CO_GRUPO": "co_area",
    "CO_CURSO": "co_curso",
    "CO_MUNIC_CURSO": "co_municipio",
}


def _sheet_texts(
    spark: SparkSession, files, layout: Layout, skip: Sequence[str], dataset: str
) -> tuple[DataFrame, dict[int, set[str]]]:
    """Canonical text rows of all years' workbooks without footers and blank rows."""
    texts, by_source = read_sheets(spark, [f.path for f in files.values()], layout, skip)
    pattern = rf"/{dataset}/(\d{{4}})/"
    years = {f.path: f.year for f in files.values()}
    published = {years[path]: names for path, names in by_source.items()}
    texts = texts.withColumn(SOURCE_YEAR, F.regexp_extract("fonte", pattern, 1).cast("int"))
    texts = texts.withColumnRenamed("linha", "_linha")
    filled = reshape.keep_any_value(texts, [c for c in layout.columns if c in texts.columns])
    return reshape.numeric_code_rows(filled, "co_ies"), published


def _year_of_file(df: DataFrame, published: dict[int, set[str]]) -> DataFrame:
    """Fill the year from the same sheet; sheets without a year column take their folder's year."""
    lacking = [y for y, names in published.items() if "ano" not in names]
    filled = reshape.fill_from_source(df, "ano", "_linha")
    if not lacking:
        return filled
    folder_year = F.when(F.col(SOURCE_YEAR).isin(*lacking), F.col(SOURCE_YEAR))
    return filled.withColumn("ano", F.coalesce("ano", folder_year))


def _build(
    spark: SparkSession, bronze: str, root: str, years: Sequence[int], force: bool,
    table: str, layout: Layout, skip: Sequence[str], clean: Callable, required: Callable,
) -> BuildReport:
    report = BuildReport(table)
    years = [y for y in years if y not in YEARS_WITHOUT_EXAM]
    files = one_per_year(find_files(spark, bronze, table, XLSX, years))
    report.failures += [
        {SOURCE_YEAR: y, "check": "source_file", "violations": 1} for y in years if y not in files
    ]
    path = silver_path(root, table)
    stale = years_to_build(spark, files.values(), path, force) if files else []
    report.unchanged = [y for y in files if y not in stale]
    if not stale:
        return report
    texts, published = _sheet_texts(spark, {y: files[y] for y in stale}, layout, skip, table)
    # Gates and write share one computation.
    cleaned = materialise(clean(texts, published).drop("fonte"))
    failures = missing_columns(published, required)
    failures += gate_years(cleaned, stale, layout.keys)
    return write_passing_years(cleaned, path, report, stale, failures)


# --- course grade -------------------------------------------------------------------------------


def rating_codes(spark: SparkSession, bronze: str, years: Sequence[int]) -> tuple[DataFrame | None, list[int]]:
    """Course codes of the rating workbooks, and the years whose workbook has the municipality."""
    years = [y for y in years if y in sheets.YEARS_WITH_RATED_COURSE]
    try:
        files = one_per_year(find_files(spark, bronze, "conceito-enade", XLSX, years)) if years else {}
    except FileNotFoundError:
        files = {}
    if not files:
        return None, []
    texts, by_source = read_sheets(
        spark, [f.path for f in files.values()], sheets.RATING, sheets.RATING_SIDE_SHEETS
    )
    placed = [f.year for f in files.values() if "co_municipio" in by_source.get(f.path, ())]
    year = F.regexp_extract("fonte", r"/conceito-enade/(\d{4})/", 1).cast("int")
    codes = texts.select(
        year.alias(SOURCE_YEAR),
        *[V.strip_quotes(F.col(c)).try_cast("bigint").alias(c) for c in sheets.RATING.columns],
    )
    return reshape.require_keys(codes, ["co_ies", "co_curso"]), placed


def exam_codes(spark: SparkSession, bronze: str, years: Sequence[int]) -> DataFrame | None:
    """Institution, area, course and municipality codes of the exam's course files."""
    try:
        files = one_per_year(
            find_files(spark, bronze, "enade-microdados", r".*arq1\.txt", years)
        ) if years else {}
    except FileNotFoundError:
        return None
    if not files:
        return None
    required = ["co_ies", "co_area", "co_curso"]
    codes, published = read_codes_of_years(spark, {y: f.path for y, f in files.items()}, CODE_COLUMNS, required)
    # A course file without the code columns recovers nothing; the year stays as published.
    if not any(names.issuperset(required) for names in published.values()):
        return None
    # Without municipality only the first level applies: a code that matches no row.
    unplaced = [y for y, names in published.items() if "co_municipio" not in names]
    place = F.when(F.col(SOURCE_YEAR).isin(*unplaced), F.lit(-1).cast("bigint")).otherwise(F.col("co_municipio"))
    return codes.withColumn("co_municipio", place) if unplaced else codes


def recover_courses(spark: SparkSession, bronze: str, cpc: DataFrame, published: dict[int, set[str]]) -> DataFrame:
    """Course codes for the years that did not publish them, in three steps of falling authority."""
    years = [y for y in published if y in sheets.YEARS_WITHOUT_COURSE]
    if not years:
        return cpc
    keys = [SOURCE_YEAR, "co_ies", "co_area"]
    rating, placed = rating_codes(spark, bronze, years)
    if rating is not None:
        placed = [y for y in placed if "co_municipio" in published[y]]
        in_place = F.col(SOURCE_YEAR).isin(*placed)
        cpc = enrich_codes(cpc, None, rating.where(in_place), keys)
        cpc = enrich_codes(cpc, None, rating.where(~in_place).drop("co_municipio"), keys)
    return enrich_codes(cpc, exam_codes(spark, bronze, years), None, keys)


def build_cpc(
    spark: SparkSession, bronze: str, root: str, years: Sequence[int], force: bool = False
) -> BuildReport:
    def clean(texts, published):
        typed = reshape.cast_lenient(texts, sheets.CPC.types)
        return recover_courses(spark, bronze, _year_of_file(typed, published), published)

    def required(year):
        names = required_for_year(sheets.CPC.required, year, sheets.CPC_NOT_PUBLISHED)
        return [c for c in names if c != "ano"]

    return _build(
        spark, bronze, root, years, force, "cpc", sheets.CPC, sheets.SIDE_SHEETS, clean, required
    )


def fact_cpc(silver: DataFrame) -> DataFrame:
    """One row per institution, area and year; unknown courses get the sentinel after that."""
    first = dedup.keep_first(silver, ["co_ies", "co_area", "ano"], SHEET_ORDER)
    coded = first.withColumn("co_curso", V.fill(F.col("co_curso"), V.UNKNOWN_COURSE))
    return reshape.canonical_only(coded.drop(*SHEET_ORDER))


# --- difference indicator -----------------------------------------------------------------------


def clean_idd(texts: DataFrame, published: dict[int, set[str]]) -> DataFrame:
    """Flag rows without grade before typing, then type, repair outliers and fill the year."""
    lacking = [y for y, names in published.items() if "idd_faixa" not in names]
    flag = V.no_grade_flag(F.col("idd_faixa"), F.col("observacao"))
    if lacking:
        flag = F.when(F.col(SOURCE_YEAR).isin(*lacking), F.lit(False)).otherwise(flag)
    flagged = texts.withColumn("in_sem_conceito", flag)
    hidden = ("idd_faixa", "idd_continuo", "nota_bruta_idd")
    flagged = flagged.withColumns({c: V.hide_when(F.col("in_sem_conceito"), F.col(c)) for c in hidden})
    typed = reshape.cast_lenient(
        flagged.withColumn("in_cebas", V.cebas_flag(F.col("in_cebas"))), sheets.IDD.types
    )
    repaired = V.repair_outlier(
        F.col("nota_bruta_idd"), F.col("idd_continuo"), F.col("idd_faixa"), F.col("in_sem_conceito")
    )
    return reshape.fill_from_source(typed.withColumn("idd_continuo", repaired), "ano", "_linha")


def build_idd(
    spark: SparkSession, bronze: str, root: str, years: Sequence[int], force: bool = False
) -> BuildReport:
    return _build(
        spark, bronze, root, years, force, "idd", sheets.IDD, sheets.SIDE_SHEETS, clean_idd,
        lambda year: sheets.IDD.required,
    )


def fact_idd(silver: DataFrame) -> DataFrame:
    """One row per institution, course and year, with both flags present and Boolean."""
    if "in_cebas" not in silver.columns:
        silver = silver.withColumn("in_cebas", V.typed_null("boolean"))
    elif dict(silver.dtypes)["in_cebas"] == "string":
        silver = silver.withColumn("in_cebas", V.cebas_flag(F.col("in_cebas")))
    else:
        silver = silver.withColumn("in_cebas", F.col("in_cebas").cast("boolean"))
    if "in_sem_conceito" in silver.columns:
        flag = F.col("in_sem_conceito").try_cast("boolean")
    else:
        flag = V.fallback_no_grade_flag(
            *[F.col(c) if c in silver.columns else None for c in ("idd_faixa", "observacao")]
        )
    flagged = silver.withColumn("in_sem_conceito", flag).drop("observacao")
    first = dedup.keep_first(flagged, ["co_ies", "co_curso", "ano"], SHEET_ORDER)
    return reshape.canonical_only(first.drop(*SHEET_ORDER))


# --- institution index --------------------------------------------------------------------------


def clean_igc(texts: DataFrame, published: dict[int, set[str]]) -> DataFrame:
    coded = texts.withColumn("in_cebas", V.cebas_code(F.col("in_cebas")))
    typed = reshape.cast_lenient(coded, sheets.IGC.types)
    return typed.withColumn("ano", F.coalesce("ano", SOURCE_YEAR))


def build_igc(
    spark: SparkSession, bronze: str, root: str, years: Sequence[int], force: bool = False
) -> BuildReport:
    return _build(
        spark, bronze, root, years, force, "igc", sheets.IGC, sheets.IGC_SIDE_SHEETS, clean_igc,
        lambda year: sheets.IGC.required,
    )


def fact_igc(silver: DataFrame) -> DataFrame:
    first = dedup.keep_first(silver, ["co_ies", "ano"], SHEET_ORDER)
    return reshape.canonical_only(first.drop(*SHEET_ORDER))


def publish_indicators(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """fact_cpc, fact_idd and fact_igc."""
    tables = {
        "fact_cpc": ("cpc", fact_cpc, ["co_ies", "co_area", "ano"], ["co_ies", "ano", "co_area"]),
        "fact_idd": ("idd", fact_idd, ["co_ies", "co_curso", "ano"], ["co_ies", "ano", "co_curso"]),
        "fact_igc": ("igc", fact_igc, ["co_ies", "ano"], ["co_ies", "ano"]),
    }
    return {
        name: publish_gold(build(read_years(spark, root, silver)), gold_path(root, name), keys, sort)
        for name, (silver, build, keys, sort) in tables.items()
    }
