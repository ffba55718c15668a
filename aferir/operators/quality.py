"""Data-quality gates as Spark aggregations.

Checks on one table are evaluated together in a single aggregation; reports are DataFrames with one
row per check, small enough to collect.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aferir.functions import values as V
from aferir.operators.join import null_safe_join


#: Failing rows that an error shows; it always states how many there are.
SHOWN = 100


class ValidationError(Exception):
    """A table failed a gate."""


@dataclass(frozen=True)
class Check:
    """A named count of violations; ``violations`` is an aggregate expression."""

    name: str
    violations: Column


def not_empty() -> Check:
    return Check("not_empty", (F.count("*") == 0).cast("bigint"))


def no_nulls(column: str) -> Check:
    return Check(f"no_nulls:{column}", F.count_if(F.col(column).isNull()))


def in_range(column: str, low: float, high: float) -> Check:
    """Values outside [low, high]; nulls are not values."""
    return Check(f"in_range:{column}", F.count_if((F.col(column) < low) | (F.col(column) > high)))


def row_rule(name: str, holds: Column) -> Check:
    return Check(f"row_rule:{name}", F.count_if(~holds))


def run_checks(df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """One row per check (and per ``by`` group): check, violations, ok."""
    results = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("check"),
                F.coalesce(c.violations, F.lit(0)).cast("bigint").alias("violations"),
            )
            for c in checks
        ]
    )
    grouped = df.groupBy(*by).agg(results.alias("_results"))
    return grouped.select(*by, F.inline("_results")).withColumn("ok", F.col("violations") == 0)


def enforce(report: DataFrame, label: str = "") -> None:
    """Raise when the report has a failing row."""
    failed = report.where(~F.col("ok"))
    shown = [r.asDict() for r in failed.limit(SHOWN).collect()]
    if shown:
        total = len(shown) if len(shown) < SHOWN else failed.count()
        raise ValidationError(f"{label}: {total} failures, of which {shown}")


def columns_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per required column: whether the table has it."""
    return _report(df, [(f"required:{c}", None, c in df.columns) for c in columns])


def types_report(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row per listed column: its type in the table (null if absent) and whether it is exactly the wanted one."""
    found = {field.name: field.dataType for field in df.schema}
    rows = []
    for name, ddl in types.items():
        kind = found.get(name)
        same = kind == T._parse_datatype_string(ddl)
        rows.append((f"type:{name}:{ddl}", kind.simpleString() if kind else None, same))
    return _report(df, rows)


def _report(df: DataFrame, rows: Sequence[tuple[str, str | None, bool]]) -> DataFrame:
    entries = [
        F.struct(F.lit(check).alias("check"), F.lit(found).cast("string").alias("found"), F.lit(ok).alias("ok"))
        for check, found, ok in rows
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*entries)))


def require_columns(df: DataFrame, columns: Sequence[str], label: str = "") -> None:
    enforce(columns_report(df, columns), label)


def require_types(df: DataFrame, types: Mapping[str, str], label: str = "") -> None:
    """Exact type of every listed column."""
    enforce(types_report(df, types), label)


def required_for_year(
    required: Sequence[str], year: int, absent: Mapping[str, Iterable[int]]
) -> list[str]:
    """Required columns without those that were not published in the year."""
    return [c for c in required if year not in set(absent.get(c, ()))]


def pk_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def pk_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, surplus rows, ok."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("linhas"), F.count("*").alias("chaves")
    ).select(
        "linhas",
        "chaves",
        (F.col("linhas") - F.col("chaves")).alias("duplicatas"),
        (F.col("linhas") == F.col("chaves")).alias("ok"),
    )


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct child keys that the parent does not have."""
    return child.select(key).distinct().join(parent.select(key), key, "left_anti")


def fk_report(child: DataFrame, parent: DataFrame, key: str, tolerance_pct: float) -> DataFrame:
    """One row: distinct child keys, orphans, orphan percentage, ok when below the tolerance."""
    known = parent.select(key).distinct().withColumn("_known", F.lit(True))
    joined = null_safe_join(child.select(key).distinct(), known, [key], "left")
    return joined.agg(
        F.count("*").alias("chaves"), F.count_if(F.col("_known").isNull()).alias("orfas")
    ).select(
        "chaves",
        "orfas",
        (V.ratio(F.col("orfas"), F.col("chaves")) * 100).alias("pct"),
        (F.col("orfas") * 100 < F.col("chaves") * F.lit(tolerance_pct)).alias("ok"),
    )


def year_coverage(
    df: DataFrame, expected: Sequence[int], forbidden: Sequence[int] = (), year: str = "ano"
) -> DataFrame:
    """One row per year that is expected, forbidden or present, with whether it is as it should be."""
    spark = df.sparkSession
    wanted = spark.createDataFrame(
        [(y, True) for y in expected] + [(y, False) for y in forbidden], "ano int, esperado boolean"
    )
    present = df.groupBy(F.col(year).cast("int").alias("ano")).agg(F.count("*").alias("linhas"))
    return wanted.join(present, "ano", "full_outer").select(
        "ano",
        V.fill(F.col("esperado"), False).alias("esperado"),
        V.fill(F.col("linhas"), 0).alias("linhas"),
        (V.fill(F.col("esperado"), False) == (V.fill(F.col("linhas"), 0) > 0)).alias("ok"),
    )


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    a: str,
    b: str,
    mean_below: float,
    max_below: float,
) -> DataFrame:
    """Compare a measure of two sources on their common keys: n, mean and largest difference, ok."""
    both = left.join(right, list(keys)).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    diff = V.abs_diff(F.col(a), F.col(b))
    summary = both.agg(
        F.count("*").alias("n"), F.avg(diff).alias("media_dif"), F.max(diff).alias("max_dif")
    )
    good = (F.col("media_dif") < mean_below) & (F.col("max_dif") < max_below)
    # Without common keys there is nothing to judge.
    return summary.withColumn("ok", F.when(F.col("n") > 0, good))


def layer_totals(gold: DataFrame, measure: str, silver: DataFrame, counted: Column) -> DataFrame:
    """One row: sum of a gold measure, count of matching silver rows, ok when equal."""
    above = gold.agg(F.sum(measure).alias("total_gold")).withColumn("total_silver", V.typed_null("bigint"))
    below = silver.agg(F.count_if(counted).alias("total_silver"))
    both = above.unionByName(below, allowMissingColumns=True)
    return both.agg(
        V.fill(F.max("total_gold"), 0).alias("total_gold"),
        V.fill(F.max("total_silver"), 0).alias("total_silver"),
    ).withColumn("ok", F.col("total_gold") == F.col("total_silver"))


def schema_drift(headers: DataFrame, column: str = "coluna", year: str = "ano") -> DataFrame:
    """For every source column the years it appears in, most frequent first.

    ``headers`` has one row per year and column name.
    """
    return (
        headers.select(year, column)
        .distinct()
        .groupBy(column)
        .agg(
            F.count("*").alias("n_anos"),
            # One entry per calendar year.
            F.array_join(F.sort_array(F.collect_set(year)), ",").alias("anos"),
        )
        .orderBy(F.desc("n_anos"), column)
    )


def filled_columns(df: DataFrame, columns: Sequence[str], year: str = "ano") -> DataFrame:
    """One row per year and column that has any value in the year: the input of ``schema_drift``."""
    filled = F.filter(
        F.array(*[F.when(F.count(c) > 0, F.lit(c)) for c in columns]), lambda x: x.isNotNull()
    )
    return df.groupBy(year).agg(filled.alias("_filled")).select(
        year, F.explode("_filled").alias("coluna")
    )
