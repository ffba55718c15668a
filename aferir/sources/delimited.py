"""Semicolon-delimited text, read as text columns and typed later."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.functions import values as V
from aferir.operators.reshape import diagonal_union, quoted
from aferir.session import materialise
from aferir.sources.records import cells_of, lines_of, read_records, unquoted
from aferir.sources.tables import SOURCE_YEAR

LATIN1 = "ISO-8859-1"
POSITION = ("_bloco", "_linha")
HEADER_JOBS = 8


def _read(spark: SparkSession, path: str | Sequence[str], encoding: str, multiline: bool) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    df = (
        spark.read.option("sep", ";")
        .option("header", True)
        .option("inferSchema", False)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(paths)
    )
    first = df.columns[0]
    bom = "\ufeff" if encoding == "UTF-8" else "\u00ef\u00bb\u00bf"
    return df.withColumnRenamed(first, first.removeprefix(bom))


def read_delimited(
    spark: SparkSession, path: str | Sequence[str], encoding: str = LATIN1, multiline: bool = False
) -> DataFrame:
    """All columns as text, tokens that mean "no value" as null, plus the row position.

    ``_bloco`` is the byte offset of the file split and ``_linha`` increases inside it, so the two
    order the rows of a file as written. Quoted line breaks need ``multiline``, which keeps a file in
    one task.
    """
    df = _read(spark, path, encoding, multiline)
    return df.select(
        *[V.drop_null_tokens(quoted(c)).alias(c) for c in df.columns],
        F.col("_metadata.file_block_start").alias("_bloco"),
        F.monotonically_increasing_id().alias("_linha"),
    )


def _cleaned(name: str) -> str:
    column = "`" + name.replace("`", "``") + "`"
    tokens = ", ".join(f"'{token}'" for token in V.NULL_TOKENS)
    return f"CASE WHEN {column} NOT IN ({tokens}) THEN {column} END"


def read_years_mapped(
    spark: SparkSession,
    paths: Mapping[int, str],
    headers: Mapping[str, str],
    columns: Sequence[str],
    position: bool = False,
    quoted_breaks: bool = False,
) -> tuple[DataFrame, dict[int, set[str]]]:
    """One file per year as text columns of a layout, stacked, and the columns each year publishes.

    Each file is read with its own header and projected once: mapped columns that exist (the first
    filled one when several feed a target), nulls for the others, and the source year. With 20 years
    and 60 columns this stays one short plan per file. ``quoted_breaks`` reads records whose quoted
    cells hold line breaks, still in splits; then all files are one plan.
    """
    if quoted_breaks:
        return _read_years_of_records(spark, paths, headers, columns, position)
    frames, published = [], {}
    opened = side_by_side(lambda path: _read(spark, path, LATIN1, False), paths.values())
    for year, df in zip(paths, opened):
        present = set(df.columns)
        sources = {c: [h for h, t in headers.items() if t == c and h in present] for c in columns}
        published[year] = {c for c, found in sources.items() if found}
        texts = [
            f"coalesce({', '.join(map(_cleaned, found))}) AS `{c}`"
            if found
            else f"CAST(NULL AS STRING) AS `{c}`"
            for c, found in sources.items()
        ]
        if position:
            texts += ["_metadata.file_block_start AS _bloco", "monotonically_increasing_id() AS _linha"]
        frames.append(df.selectExpr(*texts, f"{year} AS {SOURCE_YEAR}"))
    return diagonal_union(frames), published


def _read_years_of_records(
    spark: SparkSession, paths: Mapping[int, str], headers: Mapping[str, str], columns: Sequence[str], position: bool
) -> tuple[DataFrame, dict[int, set[str]]]:
    """All files in one plan: a small table says which cells of a file feed each column."""
    found = dict(zip(paths, side_by_side(lambda path: read_header(spark, path), paths.values())))
    feeds = {
        year: {c: [header.index(h) for h, t in headers.items() if t == c and h in header] for c in columns}
        for year, header in found.items()
    }
    published = {year: {c for c, cells in at.items() if cells} for year, at in feeds.items()}
    choices = {c: max([1, *(len(at[c]) for at in feeds.values())]) for c in columns}
    flat = lambda at: [cell for c in columns for cell in (at[c] + [-1] * choices[c])[: choices[c]]]
    names = spark.createDataFrame(
        [(path, year, flat(feeds[year])) for year, path in paths.items()], f"_caminho string, {SOURCE_YEAR} int, _celulas array<int>"
    )
    # One row per file. Spark's own reader says how it spells the path of each file.
    spelled = spark.read.format("binaryFile").load(list(paths.values())).select("path")
    bare = lambda c: F.regexp_replace(c, "^file:/+", "/")
    names = names.join(spelled, bare(F.col("_caminho")) == bare(F.col("path"))).select(
        bare(F.col("path")).alias("_arquivo"), SOURCE_YEAR, "_celulas"
    )
    rows = read_records(spark, list(paths.values()))
    rows = rows.withColumn("_arquivo", bare(F.url_decode(F.replace("fonte", F.lit("+"), F.lit("%2B")))))
    rows = rows.join(F.broadcast(names), "_arquivo").where("bloco > 0 OR linha > 0")
    # Cells are cleaned as they are cut, so the columns stay short expressions.
    cleaned = F.transform(cells_of(F.decode("registro", LATIN1)), lambda c: V.drop_null_tokens(unquoted(c)))
    rows = rows.withColumn("_valores", cleaned)
    texts, at = [], 0
    for c in columns:
        options = [F.get("_valores", F.get("_celulas", F.lit(at + i))) for i in range(choices[c])]
        texts.append((F.coalesce(*options) if len(options) > 1 else options[0]).alias(c))
        at += choices[c]
    if position:
        texts += [F.col("bloco").alias("_bloco"), F.col("linha").alias("_linha")]
    return rows.select(*texts, SOURCE_YEAR), published


def read_with_fallback(spark: SparkSession, path: str) -> DataFrame:
    """All rows of one file as text columns: UTF-8 when header and values decode, else Latin-1.

    The file is read twice; ``distinct_lines`` decides for many files in one scan.
    """
    valid = F.coalesce(F.bool_and(F.is_valid_utf8("value")), F.lit(True))
    decodes = spark.read.text(path).agg(valid).first()[0]
    df = _read(spark, path, "UTF-8" if decodes else LATIN1, False)
    return df.select([V.drop_null_tokens(quoted(c)).alias(c) for c in df.columns])


def distinct_lines(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, dict[str, tuple[str, list[str]]]]:
    """The different lines of many files, in one scan, and the encoding and header of each file.

    Every line votes while equal ones are merged: a file is UTF-8 if all its lines are, else Latin-1. The
    lines stay bytes until the vote is known; ``decoded`` turns them into text in the same plan.
    """
    text = F.col("registro").cast("string")
    lines = lines_of(spark, paths).select(
        "fonte", "registro", F.is_valid_utf8(text).alias("_utf8"), F.struct("bloco", F.monotonically_increasing_id().alias("n")).alias("_at")
    )
    merged = materialise(lines.groupBy("fonte", "registro").agg(F.min("_utf8").alias("_utf8"), F.min("_at").alias("_at")))
    # One row per file.
    votes = merged.groupBy("fonte").agg(F.min("_utf8").alias("utf8"), F.min_by("registro", "_at").alias("first")).collect()
    known = {}
    for vote in votes:
        encoding = "UTF-8" if vote.utf8 else LATIN1
        known[vote.fonte] = (encoding, header_names(bytes(vote.first).decode("utf-8" if vote.utf8 else "latin-1")))
    return merged.select("fonte", "registro"), known


def decoded(line: Column, source: Column, known: Mapping[str, tuple[str, list[str]]]) -> Column:
    """The text of a line in the encoding its file was voted to have."""
    latin = [path for path, (encoding, _) in known.items() if encoding == LATIN1]
    returned = F.regexp_replace(F.when(source.isin(latin), F.decode(line, LATIN1)).otherwise(F.decode(line, "UTF-8")), r"\r\z", "")
    return returned if latin else F.regexp_replace(F.decode(line, "UTF-8"), r"\r\z", "")


def header_names(line: str) -> list[str]:
    """Column names of a header line, without quotes, blanks and byte order mark."""
    cells = next(csv.reader([line.rstrip("\r\n").lstrip("\ufeff")], delimiter=";"), [])
    return [name.strip('" \ufeff') for name in cells]


def read_codes_of_years(
    spark: SparkSession, paths: Mapping[int, str], wanted: Mapping[str, str], required: Sequence[str]
) -> tuple[DataFrame, dict[int, set[str]]]:
    """The wanted code columns of one file per year as integers, all files in one scan, and what each publishes.

    Headers are matched without case and quotes. Bad codes become null; columns a file lacks are null. A
    year without the required columns gives no rows. The files repeat the same codes for every student, so
    equal lines are merged before they are decoded, cut and typed.
    """
    lines, known = distinct_lines(spark, list(paths.values()))
    years = {bare_path(path): year for year, path in paths.items()}
    published: dict[int, set[str]] = dict.fromkeys(paths, frozenset())
    places, targets = [], list(dict.fromkeys(wanted.values()))
    for source, (_, header) in known.items():
        year = years[bare_path(unquote(source))]
        by_key = {name.upper(): i for i, name in enumerate(header)}
        found = {target: by_key[k] for k, target in wanted.items() if k in by_key}
        published[year] = set(found)
        if not set(required) - set(found):
            places.append((source, year, [found.get(t, -1) for t in targets]))
    table = spark.createDataFrame(places, f"fonte string, {SOURCE_YEAR} int, _celulas array<int>")
    # One row per file.
    rows = lines.join(F.broadcast(table), "fonte")
    rows = rows.withColumn("_valores", cells_of(decoded(F.col("registro"), F.col("fonte"), known)))
    codes = [
        V.strip_quotes(V.drop_null_tokens(unquoted(F.get("_valores", F.get("_celulas", F.lit(i)))))).try_cast("bigint").alias(t)
        for i, t in enumerate(targets)
    ]
    header = F.upper(F.array_join("_valores", ";")).contains(next(iter(wanted)))
    return rows.where(~header).select(SOURCE_YEAR, *codes).distinct(), published


def bare_path(path: str) -> str:
    """A path without the scheme of local files, which Spark and callers write in several ways."""
    return re.sub("^file:/+", "/", path)


def side_by_side(read: Callable, paths: Iterable[str]) -> list:
    """Results of ``read`` in path order; the small header jobs run a few at a time."""
    with ThreadPoolExecutor(HEADER_JOBS) as pool:
        return list(pool.map(read, paths))


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of one file: reads the first line only."""
    first = spark.read.text(path).limit(1).select(cells_of(F.col("value")).alias("cells")).first()
    return [name.strip('" \ufeff') for name in first.cells] if first else []
