"""A layout lists published headers, the canonical column each one feeds, and its type."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.functions.values import fold_header


@dataclass(frozen=True)
class Layout:
    headers: Mapping[str, str]
    types: Mapping[str, str]
    required: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    # Headers to ignore although another spelling of them is mapped.
    ignored: frozenset[str] = field(default_factory=frozenset)

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(self.headers.values()))

    def aliases(self, spark: SparkSession) -> DataFrame:
        """Folded header and canonical column, for joining with the headers of many sources."""
        pairs = [(h, t) for h, t in self.headers.items() if not t.startswith("_")]
        table = spark.createDataFrame(pairs, "header string, target string")
        return table.withColumn("header", fold_header(F.col("header"))).distinct()


def layout(
    text: str,
    types: Mapping[str, str] | None = None,
    extra: Iterable[tuple[str, str]] = (),
    **options,
) -> Layout:
    """Read lines ``canonical type = header; header; ...`` (the type may be left out for text)."""
    headers: dict[str, str] = {}
    found: dict[str, str] = {}
    for line in text.strip().splitlines():
        if not line.strip():
            continue
        left, _, right = line.partition("=")
        target, _, ddl = left.strip().partition(" ")
        found[target] = ddl.strip() or "string"
        for header in right.split(";"):
            headers[header.strip()] = target
    headers.update(extra)
    return Layout(headers, {**found, **(types or {})}, **options)
