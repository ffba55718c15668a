"""Types of text columns, inferred over whole files and merged over files.

Types form a chain: int < bigint < double < string. A column has the smallest type that holds all its values;
nulls and tokens that mean "no value" say nothing. The type of many files is the largest of theirs, so files
and years can be inferred on their own and merged later.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.functions import values as V
from aferir.operators.reshape import cast_strict, quoted
from aferir.sources.delimited import LATIN1, POSITION, read_delimited

# The chain of types, and how numbers are written.
TYPES = ("int", "bigint", "double", "string")
WHOLE = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def rank(value: Column) -> Column:
    """Place in TYPES of the smallest type that holds a text; null for no value."""
    value = V.drop_null_tokens(value)
    whole = value.rlike(WHOLE)
    return (
        F.when(value.isNull(), None)
        .when(whole & value.try_cast("int").isNotNull(), 0)
        .when(whole & value.try_cast("bigint").isNotNull(), 1)
        .when(value.rlike(DECIMAL), 2)
        .otherwise(3)
    )


def column_types(texts: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``coluna``, ``ordem`` (place in TYPES, null if no value) and ``preenchidos``: one aggregate."""
    found = texts.groupBy(*by).agg(
        *[
            F.struct(
                F.lit(c).alias("coluna"), F.max(rank(quoted(c))).alias("ordem"),
                F.count(V.drop_null_tokens(quoted(c))).alias("preenchidos"),
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    return found.select(*by, F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))


def merged_types(types: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The types of all files or years together: the largest of each column."""
    return types.groupBy(*by, "coluna").agg(F.max("ordem").alias("ordem"), F.sum("preenchidos").alias("preenchidos"))


def named_types(types: DataFrame) -> DataFrame:
    """``tipo`` by name; a column without any value is text."""
    return types.withColumn("tipo", F.coalesce(F.get(F.array(*map(F.lit, TYPES)), "ordem"), F.lit("string"))).drop("ordem")


def inferred(texts: DataFrame, columns: Sequence[str], types: DataFrame | None = None) -> DataFrame:
    """The texts with their inferred types (of ``types``, or of the texts themselves); position columns stay."""
    if types is None:
        types = column_types(texts, columns)
    # One row per column.
    found = {r.coluna: r.tipo for r in named_types(merged_types(types)).collect()}
    cleaned = texts.select(*[V.drop_null_tokens(quoted(c)).alias(c) if c in columns else quoted(c) for c in texts.columns])
    return cast_strict(cleaned, {c: found[c] for c in columns if found.get(c, "string") != "string"})


def read_inferred(
    spark: SparkSession, paths: dict[int, str], encoding: str = LATIN1
) -> tuple[dict[int, DataFrame], DataFrame]:
    """The files of each year with the types that hold in all years, and the types per year and column.

    Every file keeps its own columns. A column that is whole in one year and text in another is text in all.
    """
    texts = {year: read_delimited(spark, path, encoding) for year, path in paths.items()}
    columns = {year: [c for c in df.columns if c not in POSITION] for year, df in texts.items()}
    yearly = [column_types(df, columns[year]).select(F.lit(year).alias("ano"), "*") for year, df in texts.items()]
    types = reduce(DataFrame.unionByName, yearly)
    return {year: inferred(df, columns[year], types) for year, df in texts.items()}, types
