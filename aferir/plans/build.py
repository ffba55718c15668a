"""Shared steps of the builds: gates per source year, writing the years that pass, gold writes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.operators import quality
from aferir.operators.quality import Check, no_nulls, not_empty
from aferir.session import materialise
from aferir.sinks.refresh import stale_years, write_gold, write_silver
from aferir.sources.discovery import SourceFile, output_manifest, source_manifest
from aferir.sources.tables import SOURCE_YEAR, read_table

Published = Mapping[int, set[str]]


@dataclass
class BuildReport:
    """What a build wrote, left alone and refused; failures name the check and the violations."""

    table: str
    written: list[int] = field(default_factory=list)
    unchanged: list[int] = field(default_factory=list)
    failures: list[dict] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.failures


def years_to_build(
    spark: SparkSession, files: Iterable[SourceFile], path: str, force: bool
) -> list[int]:
    """Source years without output or with a source newer than it."""
    stale = stale_years(source_manifest(spark, files), output_manifest(spark, path), force)
    return sorted(r.ano for r in stale.collect())


def missing_columns(
    published: Published, required: Callable[[int], Sequence[str]]
) -> list[dict]:
    return [
        {SOURCE_YEAR: year, "check": f"required:{name}", "violations": 1}
        for year, names in sorted(published.items())
        for name in required(year)
        if name not in names
    ]


def gate_years(
    df: DataFrame, years: Sequence[int], keys: Sequence[str], extra: Sequence[Check] = ()
) -> list[dict]:
    """Failing checks per source year: no rows, null keys, and the extra checks; one aggregation."""
    checks = [not_empty(), *[no_nulls(k) for k in keys], *extra]
    report = quality.run_checks(df, checks, [SOURCE_YEAR])
    results = [r.asDict() for r in report.collect()]
    present = {r[SOURCE_YEAR] for r in results}
    empty = [
        {SOURCE_YEAR: y, "check": "not_empty", "violations": 1} for y in years if y not in present
    ]
    return empty + [
        {k: r[k] for k in (SOURCE_YEAR, "check", "violations")} for r in results if not r["ok"]
    ]


def write_passing_years(
    df: DataFrame, path: str, report: BuildReport, years: Sequence[int], failures: list[dict]
) -> BuildReport:
    """Write the years without failures; a failing year keeps its previous output."""
    report.failures += failures
    failed = {f[SOURCE_YEAR] for f in failures}
    passing = [y for y in years if y not in failed]
    if passing:
        write_silver(df, path, passing)
        report.written += passing
    return report


def bad_casts(columns: Mapping[str, str]) -> list[Check]:
    """Per text column the filled values that its type does not accept."""
    return [
        Check(
            f"cast:{name}:{ddl}",
            F.count_if(F.col(name).isNotNull() & F.col(name).try_cast(ddl).isNull()),
        )
        for name, ddl in columns.items()
        if ddl != "string"
    ]


def publish_gold(
    df: DataFrame, path: str, keys: Sequence[str], sort: Sequence[str], unique: bool = True
) -> DataFrame:
    """Write a gold table, sorted, after its gates; a failing table never replaces the published one.

    The table is materialised first, so gates and write share one computation.
    """
    rows = materialise(df)
    quality.enforce(quality.run_checks(rows, [not_empty(), *[no_nulls(k) for k in keys]]), path)
    if unique:
        quality.enforce(quality.pk_report(rows, keys), path)
    write_gold(rows, path, sort)
    return read_table(rows.sparkSession, path)
