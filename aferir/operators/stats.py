"""Grouped score statistics, participation, percentiles, summaries and answer profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aferir.functions import values as V
from aferir.operators.join import null_safe_join
from aferir.operators.order import exact_medians, exact_medians_by_range, ordinal_rank, ordinal_rank_by_range


def score_stats(
    df: DataFrame,
    keys: Sequence[str],
    present: Column,
    spread: Sequence[str],
    means: Sequence[str] = (),
    meta: Sequence[str] = (),
    order: Sequence[str] = (),
    medians: Sequence[str] | None = None,
    by_range: bool = False,
) -> DataFrame:
    """Enrolled and present counts, and mean / median / deviation of the present rows' scores.

    One aggregation gives the enrolment count, mean and deviation of the present, and the first row's
    descriptive columns (``meta`` by ``order``); a group without present rows has count 0 and null
    scores. Medians are a second pass, for the ``medians`` columns only (those of ``spread`` unless
    named). A plan only, no job, unless ``by_range`` spreads the medians of large groups.
    """
    medians = spread if medians is None else medians
    rows = df.withColumn("_present", F.coalesce(present, F.lit(False)))
    aggregates = [
        F.count("*").cast("int").alias("qt_inscritos"),
        F.count_if("_present").cast("int").alias("qt_presentes"),
    ]
    for name in (*spread, *means):
        score = F.when(F.col("_present"), F.col(name))
        aggregates.append(F.avg(score).alias(f"{name}_media"))
        if name in spread:
            aggregates.append(F.stddev_samp(score).alias(f"{name}_dp"))
    if meta:
        aggregates.append(F.min_by(F.struct(*meta), F.struct(*order)).alias("_meta"))
    found = rows.groupBy(*keys).agg(*aggregates)
    if medians:
        middle = exact_medians_by_range if by_range else exact_medians
        found = null_safe_join(found, middle(rows.where("_present"), keys, medians), keys, "left")
    described = ["_meta.*"] if meta else []
    measures = [f"{name}_{kind}" for name in spread for kind in ("media", "mediana", "dp")]
    measures = [c for c in measures if c in found.columns] + [f"{name}_media" for name in means]
    return found.select(*keys, "qt_inscritos", "qt_presentes", *measures, *described)


def participation(df: DataFrame, out: str = "tx_participacao") -> DataFrame:
    return df.withColumn(out, V.ratio(F.col("qt_presentes"), F.col("qt_inscritos")))


def group_percentile(
    df: DataFrame,
    by: Sequence[str],
    score: str,
    ties: Sequence[str],
    out: str = "percentil_grupo",
    by_range: bool = False,
) -> DataFrame:
    """Position 0-100 of the score inside its group; 50 when the group has at most one score.

    Ordinal ranks (ties in ``ties`` order); rows without score get no position in larger groups. With
    ``by_range`` the rows of a group are ranked in several partitions, for groups too large for one.
    """
    if by_range:
        ranked = ordinal_rank_by_range(df, by, [score, *ties], "_rank")
        sizes = ranked.groupBy(*by).agg(F.count(score).alias("_scored"))
        ranked = null_safe_join(ranked, sizes, by, "left")
    else:
        scored = F.count(score).over(Window.partitionBy(*by))
        ranked = ordinal_rank(df, by, [score, *ties], "_rank").withColumn("_scored", scored)
    position = V.ratio(F.col("_rank") - 1, F.col("_scored") - 1) * 100
    return ranked.withColumn(
        out, F.when(F.col("_scored") > 1, V.round_half_even(position)).otherwise(F.lit(50.0))
    ).drop("_rank", "_scored")


def year_summary(df: DataFrame, score: str, year: str = "ano") -> DataFrame:
    """Mean score, present rows and courses per year, over courses with someone present."""
    return (
        df.where("qt_presentes > 0")
        .groupBy(year)
        .agg(
            F.avg(score).alias("media_geral"),
            F.sum("qt_presentes").alias("total_presentes"),
            F.count("*").alias("cursos"),
        )
        .orderBy(year)
    )


def code_bitmaps(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct values of whole-number columns as bitmaps: ``by``, ``coluna``, ``balde``, ``mapa``.

    A bitmap stands for 32,768 neighbouring codes in four kilobytes. Each column is its own pruned read and
    its own aggregate, so no row is multiplied, and what is shuffled are bitmaps, not values.
    """
    found = []
    for c in columns:
        code = F.col(c).cast("bigint")
        buckets = df.where(code.isNotNull()).groupBy(
            *by, F.lit(c).alias("coluna"), F.bitmap_bucket_number(code).alias("balde")
        )
        found.append(buckets.agg(F.bitmap_construct_agg(F.bitmap_bit_position(code)).alias("mapa")))
    return reduce(DataFrame.unionByName, found)


def bitmap_counts(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values per column of bitmaps of any finer grouping: ``by``, ``coluna``, ``distintos``."""
    whole = bitmaps.groupBy(*by, "coluna", "balde").agg(F.bitmap_or_agg("mapa").alias("mapa"))
    return whole.groupBy(*by, "coluna").agg(F.sum(F.bitmap_count("mapa")).alias("distintos"))


def _distinct_counts(df: DataFrame, distinct: Mapping[str, str]) -> DataFrame:
    """One row with the distinct count of each column: bitmaps for whole numbers, else a distinct pass each."""
    kinds = dict(df.dtypes)
    codes = [c for c in dict.fromkeys(distinct.values()) if kinds.get(c) in ("tinyint", "smallint", "int", "bigint")]
    others = [c for c in dict.fromkeys(distinct.values()) if c not in codes]
    found = [bitmap_counts(code_bitmaps(df, codes))] if codes else []
    for c in others:
        counted = df.select(F.col(c).alias("_v")).distinct().agg(F.count("_v").alias("distintos"))
        found.append(counted.select(F.lit(c).alias("coluna"), "distintos"))
    counts = reduce(DataFrame.unionByName, found)
    number = lambda c: F.coalesce(F.max(F.when(F.col("coluna") == c, F.col("distintos"))), F.lit(0).cast("long"))
    return counts.agg(*[number(c).alias(out) for out, c in distinct.items()])


def build_summary(
    df: DataFrame,
    distinct: Mapping[str, str],
    flags: Mapping[str, Column] | None = None,
    filled: Sequence[str] = (),
    year: str = "ano",
) -> DataFrame:
    """One row: row count, distinct counts, years, flag counts, and null count / fill % of columns.

    Everything but the distinct counts rolls up from a per-year aggregate; each distinct count is a pass
    over its own column (``code_bitmaps``), so rows are never multiplied by the number of counts.
    """
    flags = flags or {}
    counted = [F.count_if(cond).alias(out) for out, cond in flags.items()]
    counted += [F.count(c).alias(f"_{c}") for c in filled]
    by_year = df.groupBy(F.col(year).alias("ano")).agg(F.count("*").alias("linhas"), *counted)
    # One entry per calendar year.
    years = F.array_join(F.sort_array(F.collect_set("ano")), ",").alias("anos")
    sums = [F.sum(c).alias(c) for c in ("linhas", *flags, *[f"_{c}" for c in filled])]
    totals = by_year.agg(years, *sums)
    both = totals
    if distinct:
        both = totals.unionByName(_distinct_counts(df, distinct), allowMissingColumns=True)
    row = both.agg(*[F.max(c).alias(c) for c in both.columns])
    measures = []
    for c in filled:
        measures.append((F.col("linhas") - F.col(f"_{c}")).alias(f"{c}_nulos"))
        share = V.ratio(F.col(f"_{c}"), F.col("linhas")) * 100
        measures.append(share.alias(f"{c}_preenchido_pct"))
    return row.select("linhas", *distinct, "anos", *flags, *measures)


def value_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum, mean and largest absolute value of each column, one row per column."""
    row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("coluna"),
                F.min(c).cast("double").alias("minimo"),
                F.max(c).cast("double").alias("maximo"),
                F.avg(c).alias("media"),
                F.max(F.abs(c)).cast("double").alias("max_abs"),
            ).alias(c)
            for c in columns
        ]
    )
    return row.select(F.inline(F.array(*columns)))


def answer_shares(answers: DataFrame, period: str, unit: Sequence[str]) -> DataFrame:
    """Long profile: per period, unit, question and given answer its count, respondents and share.

    ``answers`` is long: period, unit, ``questao``, ``resposta``; unanswered questions do not count.
    No bound on the number of answers: a text nobody listed is a row like any other.
    """
    keys = [period, *unit, "questao"]
    valid = answers.where(F.col("resposta").isNotNull())
    counts = valid.groupBy(*keys, "resposta").agg(F.count("*").alias("n"))
    # A row for each answer that a unit gave to a question.
    counts = counts.withColumn("respondentes", F.sum("n").over(Window.partitionBy(*keys)))
    return counts.withColumn("parte", V.ratio(F.col("n"), F.col("respondentes")))


def profile_columns(given: Mapping[str, Sequence[str]]) -> dict[str, tuple[str, str]]:
    """Column name of each question and answer; two pairs with one name are an error."""
    names: dict[str, tuple[str, str]] = {}
    for question, letters in given.items():
        for answer in letters:
            if names.setdefault(f"{question}_{answer}", (question, answer)) != (question, answer):
                raise ValueError(f"two questions share the column {question}_{answer}")
    return names


def answer_profile(
    answers: DataFrame, period: str, unit: Sequence[str], given: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Wide profile for a given answer list: ``{questao}_{resposta}`` and ``{questao}_respondentes``.

    A unit with respondents but without an answer that occurs in the period has share 0.0; a unit
    without respondents, or an answer nobody gave in the period, is null. Answers outside the list
    count as respondents only.
    """
    keys, names = [period, *unit], profile_columns(given)
    shares = answer_shares(answers, period, unit)
    picked = lambda question, answer: (F.col("questao") == question) & (F.col("resposta") == answer)
    asked = [
        F.max(F.when(F.col("questao") == q, F.col("respondentes"))).alias(f"{q}_respondentes") for q in given
    ]
    parts = [F.max(F.when(picked(*pair), F.col("parte"))).alias(name) for name, pair in names.items()]
    wide = shares.groupBy(*keys).agg(*asked, *parts)
    # One row per period: which of the listed answers occur in it.
    occurs = [F.max(picked(*pair)).alias(f"_{name}") for name, pair in names.items()]
    seen = answers.where(F.col("resposta").isNotNull()).groupBy(period).agg(*occurs)
    wide = null_safe_join(wide, seen, [period], "left")
    columns = []
    for question, letters in given.items():
        columns.append(F.col(f"{question}_respondentes"))
        for name in dict.fromkeys(f"{question}_{answer}" for answer in letters):
            here = F.col(f"_{name}") & F.col(f"{question}_respondentes").isNotNull()
            columns.append(F.when(here, V.fill(F.col(name), 0.0)).alias(name))
    return wide.select(*keys, *columns)
