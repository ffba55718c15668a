"""Joins that survive a key holding a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts that the rows of one key are spread over.
SALTS = 8


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join where null keys match, keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def _spread(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Columns that tell the rows of a key apart: the first and the last four besides the keys.

    Not all of them: the optimizer rewrites a condition once for every renaming of every column in it,
    so a hash of fifty columns would take longer to plan than to run. Maps cannot be hashed.
    """
    names = [f.name for f in df.schema.fields if f.name not in keys and "map<" not in f.dataType.simpleString()]
    return [F.col(f"`{name}`") for name in dict.fromkeys([*names[:4], *names[-4:]])] or [F.lit(0)]


def join_unique(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join facts with a lookup that has one row per key; a plan only, no job.

    The facts of a key are dealt over ``salts`` parts and the lookup row is repeated for each, so a hot
    key is never one task. The salt also drops the partitioning that a grouped lookup brings along:
    both sides are then shuffled for this join, and adaptive execution can split a part that is still
    too large. The merge hint keeps the repeated rows off the driver: the planner sizes the lookup without
    the repetition and would broadcast ``salts`` times what it takes for small.

    The salt is a hash of the row's values, never of its place: a task that runs again after a lost
    executor sends every row to the same part. Rows alike share a part; adaptive execution splits it.
    """
    dealt = facts.withColumn("_sal", F.pmod(F.xxhash64(*_spread(facts, keys)), F.lit(salts)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_sal")
    return dealt.join(lookup.select("*", every).hint("merge"), [*keys, "_sal"], how).drop("_sal")
