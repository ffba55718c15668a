"""Ranks and medians, also of groups that hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aferir.operators.join import null_safe_join
from aferir.session import broadcast_if_small, materialise


def _sorting(order: Sequence[str]) -> list:
    return [F.col(order[0]).asc_nulls_last(), *[F.col(c).asc() for c in order[1:]]]


def ordinal_rank(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """1-based rank by the order columns inside each group; rows with a null score get null.

    ``order`` is the score, then tie-breaks of any orderable type. One window: the rows of a group are
    sorted in one task (and spill there); ``ordinal_rank_by_range`` spreads them.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*_sorting(order)))
    return df.withColumn(out, F.when(F.col(order[0]).isNotNull(), rank))


def ordinal_rank_by_range(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """The same rank with every group spread over as many partitions as its rows need.

    Rows are dealt by ranges of (group, order columns), ranked inside each partition, and shifted by
    the group's rows in the partitions before. The dealt rows are kept, as two passes must see the
    same partitions.
    """
    score = F.col(order[0])
    dealt = df.where(score.isNotNull()).repartitionByRange(*by, *order)
    dealt = materialise(dealt.withColumn("_part", F.spark_partition_id()))
    parts = [*by, "_part"]
    # A row for each group and partition.
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(*parts).agg(F.count("*").alias("_n"))
    sizes = sizes.select(*parts, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*parts).orderBy(*_sorting(order)))
    ranked = null_safe_join(dealt.withColumn("_within", within), broadcast_if_small(materialise(sizes)), parts, "inner")
    ranked = ranked.withColumn(out, (F.col("_before") + F.col("_within")).cast("int"))
    unscored = df.where(score.isNull()).withColumn(out, F.lit(None).cast("int"))
    return ranked.select(*df.columns, out).unionByName(unscored)


def _counted(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Group, name of the column, value and how often it occurs: equal values are counted before the shuffle."""
    long = F.inline(F.array(*[F.struct(F.lit(c).alias("_name"), F.col(c).cast("double").alias("_v")) for c in columns]))
    return df.select(*by, long).where("_v IS NOT NULL").groupBy(*by, "_name", "_v").agg(F.count("*").alias("_c"))


def _wide(middle: DataFrame, by: Sequence[str], columns: Sequence[str], suffix: str, value: Column) -> DataFrame:
    return middle.groupBy(*by).agg(
        *[F.sum(F.when(F.col("_name") == c, value)).alias(f"{c}{suffix}") for c in columns]
    )


def exact_medians(df: DataFrame, by: Sequence[str], columns: Sequence[str], suffix: str = "_mediana") -> DataFrame:
    """Exact medians (midpoint for even counts) of several columns per group; a plan only, no job.

    A group's distinct values are sorted in one task; ``exact_medians_by_range`` spreads them.
    """
    parts = [*by, "_name"]
    running = Window.partitionBy(*parts).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = _counted(df, by, columns).withColumns(
        {"_upto": F.sum("_c").over(running), "_total": F.sum("_c").over(Window.partitionBy(*parts))}
    )
    low, high = F.expr("(_total + 1) div 2"), F.expr("_total div 2 + 1")
    reached = lambda at: ((F.col("_upto") - F.col("_c") < at) & (F.col("_upto") >= at)).cast("int")
    middle = placed.withColumn("_hits", reached(low) + reached(high)).where("_hits > 0")
    return _wide(middle, by, columns, suffix, F.col("_v") * F.col("_hits") / 2)


def exact_medians_by_range(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], suffix: str = "_mediana"
) -> DataFrame:
    """The same medians by order-statistic selection, for groups of any size.

    Values are dealt by ranges of (group, column, value). The counts of a group's ranges, at most one
    number per range, name the range that holds the middle; only there are values put in order. The
    dealt values are kept, as two passes must see the same ranges.
    """
    parts = [*by, "_name"]
    dealt = _counted(df, by, columns).repartitionByRange(*parts, "_v")
    dealt = materialise(dealt.withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy(*parts, "_part").agg(F.sum("_c").alias("_n"))
    ranges = F.sort_array(F.collect_list(F.struct("_part", "_n"))).alias("_ranges")
    totals = sizes.groupBy(*parts).agg(ranges, F.sum("_n").alias("_total"))

    def holding(at: Column) -> Column:
        """The range with the ``at``-th value, and the values before that range."""
        nothing = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(-1).alias("part"), F.lit(0).cast("long").alias("before"))

        def step(found, here):
            upto = found["upto"] + here["_n"]
            hit = (found["part"] < 0) & (upto >= at)
            return F.struct(
                upto.alias("upto"),
                F.when(hit, here["_part"]).otherwise(found["part"]).alias("part"),
                F.when(hit, found["upto"]).otherwise(found["before"]).alias("before"),
            )

        found = F.aggregate("_ranges", nothing, step)
        return F.struct(found["part"].alias("_part"), (at - found["before"]).alias("_at"))

    middles = F.array(holding(F.expr("(_total + 1) div 2")), holding(F.expr("_total div 2 + 1")))
    wanted = totals.select(*parts, F.posexplode(middles).alias("_which", "_middle"))
    wanted = wanted.select(*parts, "_which", "_middle._part", "_middle._at")
    near = null_safe_join(dealt, wanted, [*parts, "_part"], "inner")
    running = Window.partitionBy(*parts, "_part", "_which").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    middle = near.withColumn("_upto", F.sum("_c").over(running)).where("_upto >= _at AND _upto - _c < _at")
    return _wide(middle, by, columns, suffix, F.col("_v") / 2)
