"""Integrity report, summaries and header profile over the built layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.operators import quality, reshape, stats
from aferir.plans.indicators import XLSX
from aferir.schemas import enade, sheets
from aferir.schemas.common import EXAM_YEARS, YEARS_WITHOUT_EXAM
from aferir.sources.discovery import find_files, one_per_year
from aferir.sources.tables import SOURCE_YEAR, gold_path, read_table, read_years
from aferir.sources.workbook import read_workbooks

PRIMARY_KEYS = {
    "fact_enade": ["co_ies", "co_curso", "ano"],
    "fact_igc": ["co_ies", "ano"],
    "fact_idd": ["co_ies", "co_curso", "ano"],
    "fact_cpc": ["co_ies", "co_area", "ano"],
    "fact_censo_ies": ["co_ies", "ano"],
    "fact_censo_cursos": ["co_ies", "co_curso", "ano"],
    "dim_ies": ["co_ies"],
    "hist_ies": ["co_ies", "ano"],
}

# Orphan tolerance in percent, value ranges, and largest differences to CPC.
ORPHAN_TOLERANCE = {"fact_enade": 10, "fact_igc": 1, "fact_censo_cursos": 1}
RANGES = {
    "fact_enade": {
        "nt_ger_media": (0, 100),
        "nt_fg_media": (0, 100),
        "nt_ce_media": (0, 100),
        "percentil_grupo": (0, 100),
        "tx_participacao": (0, 1),
    },
    "fact_igc": {"igc_continuo": (0, 5), "igc_faixa": (1, 5)},
}
CPC_FROM_YEAR, CPC_MEAN_DIFFERENCE, CPC_MAX_DIFFERENCE = 2017, 0.5, 1.0


def _gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    found = {}
    for name in (*PRIMARY_KEYS, "fact_enade_perfil"):
        try:
            found[name] = read_table(spark, gold_path(root, name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def _row(report: DataFrame, table: str, check: str, value: str) -> DataFrame:
    return report.select(
        F.lit(table).alias("tabela"),
        F.lit(check).alias("check"),
        F.col(value).cast("double").alias("valor"),
        "ok",
    )


def enade_against_cpc(fact_enade: DataFrame, fact_cpc: DataFrame) -> DataFrame:
    """General-formation mean of the exam against the raw score in CPC, courses known in both."""
    keys = ["co_ies", "co_curso", "ano"]
    rated = fact_cpc.where((F.col("co_curso") > 0) & (F.col("ano") >= CPC_FROM_YEAR))
    return quality.reconcile(
        rated.select(*keys, "nota_bruta_fg"), fact_enade.select(*keys, "nt_fg_media"), keys,
        "nota_bruta_fg", "nt_fg_media", CPC_MEAN_DIFFERENCE, CPC_MAX_DIFFERENCE,
    )


def integrity_report(
    spark: SparkSession, root: str, exam_years: Sequence[int] = EXAM_YEARS
) -> DataFrame:
    """One row per check (table, check, value, ok) over the gold tables that exist."""
    gold = _gold(spark, root)
    reports = [
        _row(quality.pk_report(gold[t], keys), t, "pk", "duplicatas")
        for t, keys in PRIMARY_KEYS.items()
        if t in gold
    ]
    if "dim_ies" in gold:
        reports += [
            _row(quality.fk_report(gold[t], gold["dim_ies"], "co_ies", limit), t, "fk:dim_ies", "pct")
            for t, limit in ORPHAN_TOLERANCE.items()
            if t in gold
        ]
    checks = {
        t: [quality.in_range(c, *limits) for c, limits in columns.items()] for t, columns in RANGES.items()
    }
    if "fact_enade" in gold:
        enrolled = F.col("qt_presentes") <= F.col("qt_inscritos")
        checks["fact_enade"].append(quality.row_rule("presentes_ate_inscritos", enrolled))
        checks["fact_enade"] += [quality.no_nulls(k) for k in PRIMARY_KEYS["fact_enade"]]
    if "fact_enade_perfil" in gold:
        checks["fact_enade_perfil"] = [
            quality.in_range(c, 0, 1)
            for c in gold["fact_enade_perfil"].columns
            if c.startswith("qe_") and not c.endswith("_respondentes")
        ]
    for t, listed in checks.items():
        if t in gold and listed:
            report = quality.run_checks(gold[t], listed)
            reports.append(
                report.select(
                    F.lit(t).alias("tabela"), "check", F.col("violations").cast("double").alias("valor"), "ok"
                )
            )
    if "fact_enade" in gold:
        fact = gold["fact_enade"]
        covered = quality.year_coverage(fact, exam_years, YEARS_WITHOUT_EXAM)
        years = covered.agg(F.count_if(~F.col("ok")).alias("n"), F.every("ok").alias("ok"))
        reports.append(_row(years, "fact_enade", "anos", "n"))
        students = read_years(spark, root, "enade_microdados")
        totals = quality.layer_totals(
            fact, "qt_presentes", students, F.col("tp_pres") == enade.PRESENT
        )
        reports.append(_row(totals, "fact_enade", "total_presentes", "total_silver"))
        cleaned = quality.year_coverage(students, exam_years, YEARS_WITHOUT_EXAM, SOURCE_YEAR)
        kept = cleaned.agg(F.count_if(~F.col("ok")).alias("n"), F.every("ok").alias("ok"))
        reports.append(_row(kept, "enade_microdados", "anos", "n"))
        if "fact_cpc" in gold:
            compared = enade_against_cpc(fact, gold["fact_cpc"])
            reports.append(_row(compared, "fact_enade", "cpc", "max_dif"))
    return reshape.diagonal_union(reports)


def gold_summary(spark: SparkSession, root: str) -> DataFrame:
    """Rows, institutions, courses, years and flag counts of every built table, one row each."""
    summaries = []
    for name, df in _gold(spark, root).items():
        if "ano" not in df.columns:
            df = df.withColumn("ano", F.col("ano_referencia"))
        distinct = {out: c for out, c in (("ies", "co_ies"), ("cursos", "co_curso")) if c in df.columns}
        if "co_curso" in df.columns:
            known = F.when(F.col("co_curso") != -1, F.col("co_curso"))
            df = df.withColumn("_curso", known)
            distinct["cursos"] = "_curso"
        flags = {}
        types = dict(df.dtypes)
        if types.get("in_sem_conceito") == "boolean":
            flags["sem_conceito"] = F.col("in_sem_conceito")
        if types.get("in_cebas") == "boolean":
            flags["cebas"] = F.col("in_cebas")
        if "co_curso" in df.columns and name == "fact_cpc":
            flags["sem_curso"] = F.col("co_curso") == -1
        one = stats.build_summary(df, distinct, flags)
        summaries.append(one.select(F.lit(name).alias("tabela"), "*"))
    return reshape.diagonal_union(summaries)


def header_profile(
    spark: SparkSession, bronze: str, dataset: str, years: Sequence[int], skip: Sequence[str] = sheets.SIDE_SHEETS
) -> DataFrame:
    """Published headers of a dataset's workbooks with the years they appear in."""
    files = one_per_year(find_files(spark, bronze, dataset, XLSX, years))
    rows = read_workbooks(spark, [f.path for f in files.values()], skip).where("linha = 1")
    year = F.regexp_extract("fonte", rf"/{dataset}/(\d{{4}})/", 1).cast("int")
    headers = rows.select(year.alias("ano"), F.posexplode("cells").alias("pos", "coluna"))
    named = headers.withColumn(
        "coluna", F.coalesce("coluna", F.concat(F.lit("col_"), F.col("pos").cast("string")))
    )
    return quality.schema_drift(named)
