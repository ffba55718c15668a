"""Lookup joins, unambiguous codes, and the cascade that recovers missing course codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aferir.functions import values as V
from aferir.operators.dedup import any_one
from aferir.operators.join import SALTS, join_unique
from aferir.operators.reshape import require_keys


def lookup_join(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], fields: Sequence[str], salts: int = SALTS
) -> DataFrame:
    """Left join with the lookup reduced to one row per key, so facts never multiply."""
    return join_unique(facts, any_one(lookup.select(*keys, *fields), keys), keys, "left", salts)


def unambiguous(df: DataFrame, keys: Sequence[str], code: str, out: str) -> DataFrame:
    """Keys with exactly one distinct code, and that code.

    One distinct value means minimum = maximum, so no distinct pass is needed and the rows of a hot
    key are reduced before the shuffle.
    """
    grouped = df.groupBy(*keys).agg(F.min(code).alias(out), F.max(code).alias("_high"))
    return grouped.where(F.col(out) == F.col("_high")).drop("_high")


def _tagged(df: DataFrame, source: str, keys: list[str], place: str, code: str, placed: bool) -> DataFrame:
    where = F.col(place) if placed else V.typed_null("string")
    return df.select(*keys, where.alias("_place"), F.lit(source).alias("_source"), F.col(code).alias("_code"))


def code_table(
    micro: DataFrame | None, direct: DataFrame | None, keys: Sequence[str], place: str, code: str, placed: bool
) -> DataFrame:
    """One row per key with all that the cascade may need, so that one join resolves every level.

    ``_direct`` and ``_direct_places`` (place to code), ``_by_key``, ``_places`` (place to code); a code is
    there only if it is the only one. Micro rows with any null are left out before that is judged. A row
    holds at most the places of its key that have one code.
    """
    keys = list(keys)
    micro_placed = micro is not None and place in micro.columns
    direct_placed = direct is not None and placed and place in direct.columns
    sources = []
    if direct is not None:
        sources.append(_tagged(direct.where(F.col(code).isNotNull()), "direct", keys, place, code, direct_placed))
    if micro is not None:
        full = [*keys, place] if micro_placed else keys
        known = require_keys(micro.select(*full, code), [*full, code])
        sources.append(_tagged(known, "micro", keys, place, code, micro_placed))
    # Codes of a place first: this is where rows become few.
    ranges = [df.groupBy(*keys, "_place", "_source").agg(F.min("_code").alias("_low"), F.max("_code").alias("_high")) for df in sources]
    rows = ranges[0] if len(ranges) == 1 else ranges[0].unionByName(ranges[1])

    def only(source: str) -> Column:
        here = F.col("_source") == source
        low, high = F.min(F.when(here, F.col("_low"))), F.max(F.when(here, F.col("_high")))
        return F.when(low == high, low)

    def places(source: str, wanted: bool) -> Column:
        one = (F.col("_source") == source) & (F.col("_low") == F.col("_high")) & F.col("_place").isNotNull()
        entry = F.struct(F.col("_place").alias("key"), F.col("_low").alias("value"))
        return F.map_from_entries(F.collect_list(F.when(one & F.lit(wanted), entry)))

    return rows.groupBy(*keys).agg(
        (F.lit(None).cast("bigint") if direct_placed else only("direct")).alias("_direct"),
        places("direct", direct_placed).alias("_direct_places"),
        only("micro").alias("_by_key"),
        places("micro", micro_placed and placed).alias("_places"),
    )


def enrich_codes(
    base: DataFrame,
    micro: DataFrame | None,
    direct: DataFrame | None = None,
    keys: Sequence[str] = ("ano", "co_ies", "co_area"),
    place: str = "co_municipio",
    code: str = "co_curso",
    salts: int = 1,
) -> DataFrame:
    """Fill a missing code from lookups, first match wins, ambiguous keys never match; a plan only.

    1. ``direct``: an authoritative table of keys (and place, when both sides have it) and code.
    2. ``micro`` by keys.  3. ``micro`` by keys and place.

    All levels come from one row per key (``code_table``) and one join, whose hot keys adaptive execution
    splits. With ``salts`` the rows of a key are dealt by their place over so many parts before that, and
    a part's lookup row has the places of that part only.
    """
    keys, columns = list(keys), base.columns
    if code not in columns:
        base = base.withColumn(code, V.typed_null("bigint"))
    if micro is None and direct is None:
        return base
    table = code_table(micro, direct, keys, place, code, place in columns)
    kind = table.schema["_places"].dataType.keyType
    at = F.col(place).try_cast(kind) if place in columns else F.lit(None).cast(kind)
    if salts > 1:
        part = lambda value: F.pmod(F.hash(value.cast("string")), F.lit(salts))
        table = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_part"))
        mine = lambda name: F.map_filter(name, lambda where, _: part(where) == F.col("_part")).alias(name)
        table = table.select(*keys, "_part", "_direct", mine("_direct_places"), "_by_key", mine("_places"))
        joined = base.withColumn("_part", part(at)).join(table, [*keys, "_part"], "left")
    else:
        joined = base.join(table, keys, "left")
    levels = [F.col("_direct"), F.try_element_at("_direct_places", at), F.col("_by_key"), F.try_element_at("_places", at)]
    names = [c for c in [*columns, code] if c in joined.columns]
    found = V.first_filled(F.col(code), *levels)
    return joined.withColumn(code, found).select(*dict.fromkeys(names))
