"""Projections, renames, casts, filters, unions and header promotion."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aferir.functions import values as V
from aferir.operators.join import join_unique
from aferir.session import materialise


def quoted(name: str) -> Column:
    """Column by literal name, whatever dots or blanks it contains."""
    return F.col("`" + name.replace("`", "``") + "`")


def _by_position(df: DataFrame) -> DataFrame:
    """Neutral positional names, so headers that differ only by case stay apart."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def select_mapped(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped source columns that exist and rename them, in map order.

    A target that several source columns claim takes the first filled one.
    """
    position = {name: i for i, name in enumerate(df.columns)}
    sources: dict[str, list[Column]] = {}
    for source, target in mapping.items():
        if source in position:
            sources.setdefault(target, []).append(F.col(f"_c{position[source]}"))
    picked = [
        (cols[0] if len(cols) == 1 else F.coalesce(*cols)).alias(target)
        for target, cols in sources.items()
    ]
    return _by_position(df).select(picked)


def rename_keep(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename mapped columns and keep all others."""
    return df.toDF(*[mapping.get(name, name) for name in df.columns])


def rename_first_wins(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename; drop targets that start with ``_`` and later claims on a taken target."""
    taken: set[str] = set()
    picked = []
    for i, name in enumerate(df.columns):
        target = mapping.get(name)
        if target is None:
            picked.append(F.col(f"_c{i}").alias(name))
        elif not target.startswith("_") and target not in taken:
            taken.add(target)
            picked.append(F.col(f"_c{i}").alias(target))
    return _by_position(df).select(picked)


def canonical_only(df: DataFrame) -> DataFrame:
    """Keep columns whose name is all lower case and has no blank."""
    keep = [i for i, name in enumerate(df.columns) if name == name.lower() and " " not in name]
    names = df.columns
    return _by_position(df).select([F.col(f"_c{i}").alias(names[i]) for i in keep])


def keys_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys in the given order, then the other columns by name."""
    rest = sorted(name for name in df.columns if name not in keys)
    return df.select([quoted(name) for name in (*keys, *rest)])


def suffix_columns(df: DataFrame, names: Iterable[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({name: name + suffix for name in names if name in df.columns})


def cast_strict(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed cast of the columns present; a bad value fails the job (ANSI mode)."""
    return df.select(
        [
            quoted(name).cast(types[name]).alias(name) if name in types else quoted(name)
            for name in df.columns
        ]
    )


# Texts a cast can accept at all. Spark raises and catches an exception for every text it rejects,
# which costs far more than this test, so hopeless texts are nulled before the cast.
_CASTABLE = {
    "int": r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*\z",
    "bigint": r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*\z",
    "float": r"(?i)[0-9]|nan|inf",
    "double": r"(?i)[0-9]|nan|inf",
}


def cast_lenient(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed cast of the columns present; a bad value becomes null."""
    found = dict(df.dtypes)

    def typed(name: str) -> Column:
        c, ddl = quoted(name), types.get(name)
        if ddl is None:
            return c
        if found[name] == "string" and ddl in _CASTABLE:
            c = F.when(c.rlike(_CASTABLE[ddl]), c)
        return c.try_cast(ddl).alias(name)

    return df.select([typed(name) for name in df.columns])


def conform(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add the canonical columns a frame lacks as typed nulls; others are kept."""
    lacking = [V.typed_null(ddl).alias(name) for name, ddl in types.items() if name not in df.columns]
    return df.select("*", *lacking)


def keep_any_value(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with at least one filled cell."""
    return df.dropna(how="all", subset=list(columns) if columns else None)


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any null."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def numeric_code_rows(df: DataFrame, column: str) -> DataFrame:
    """Drop footer and note rows: the code column must be all digits."""
    return df.where(V.only_digits(quoted(column)))


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all filled."""
    return df.where(reduce(lambda a, b: a & b, [quoted(k).isNotNull() for k in keys]))


def where_code(df: DataFrame, column: str, code) -> DataFrame:
    return df.where(quoted(column) == code)


def identified_only(df: DataFrame, column: str = "co_curso") -> DataFrame:
    """Rows whose course code is known (not the sentinel)."""
    return df.where(quoted(column) != V.UNKNOWN_COURSE)


def parse_years(spec: str, skip: Iterable[int] = (), first: int | None = None) -> list[int]:
    """``2018,2020-2022`` as a sorted distinct list, without ``skip``; years before ``first`` fail."""
    years: set[int] = set()
    for part in spec.split(","):
        match = re.fullmatch(r"\s*(\d{4})(?:-(\d{4}))?\s*", part)
        if not match:
            raise ValueError(f"not a year or a range of years: {part!r}")
        low = int(match[1])
        years.update(range(low, int(match[2] or low) + 1))
    if first is not None and years and min(years) < first:
        raise ValueError(f"years before {first} are not supported: {min(years)}")
    return sorted(years - set(skip))


def where_years(df: DataFrame, years: Iterable[int], column: str = "ano") -> DataFrame:
    """Literal year set, so a table partitioned by the column is pruned."""
    return df.where(quoted(column).isin(*years))


def diagonal_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def header_positions(
    rows: DataFrame, is_header: Column, aliases: DataFrame, ignored: Iterable[str] = ()
) -> DataFrame:
    """One row per source: map from canonical name to cell position.

    ``rows`` holds ``fonte`` and ``cells`` (array of text); ``aliases`` maps folded headers to
    canonical names. Of equal headers in one source the last column counts; of several headers with
    one target the first counts.
    """
    cells = (
        rows.where(is_header)
        .select("fonte", F.posexplode("cells").alias("pos", "raw"))
        .where(F.col("raw").isNotNull())
        .withColumn("raw", V.strip_text(F.col("raw")))
        .groupBy("fonte", "raw")
        .agg(F.min("pos").alias("first_pos"), F.max("pos").alias("pos"))
        .where(~F.col("raw").isin(*ignored))
        .withColumn("header", V.fold_header(F.col("raw")))
    )
    # The alias list is a constant of the layout, well under 1,000 rows.
    named = cells.join(F.broadcast(aliases), "header")
    first = named.groupBy("fonte", "target").agg(F.min_by("pos", "first_pos").alias("pos"))
    # collect_list holds one entry per column of one source.
    return materialise(
        first.groupBy("fonte").agg(
            F.map_from_entries(F.collect_list(F.struct("target", "pos"))).alias("positions")
        )
    )


def promote_header(
    rows: DataFrame, is_header: Column, positions: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Data rows as wide typed-later columns: each canonical column reads the cell its header names.

    No pivot: one join with a row per source, then array access. Columns a source lacks are null.
    """
    keep = [c for c in rows.columns if c != "cells"]
    located = join_unique(rows.where(~is_header), positions, ["fonte"], "inner")
    return located.select(
        *keep,
        *[F.get("cells", F.try_element_at("positions", F.lit(name))).alias(name) for name in columns],
    )


def fill_from_source(df: DataFrame, column: str, order: str, source: str = "fonte") -> DataFrame:
    """Fill a missing value with the first filled one of the same source.

    The first values are an aggregate with one row per source, joined back, so a large source is
    never gathered in one task.
    """
    value = quoted(column)
    first = df.where(value.isNotNull()).groupBy(source).agg(F.min_by(column, order).alias("_first"))
    joined = join_unique(df, first, [source])
    return joined.withColumn(column, F.coalesce(value, "_first")).drop("_first")
