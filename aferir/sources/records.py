"""Records of delimited text whose quoted cells hold line breaks, from files that are read in splits.

A line break ends a record only where an even number of quotes stands before it. Each split of a file
counts its quotes; the counts of the splits before say whether a split starts inside a quoted cell; then
every split cuts its lines into records on its own. What a split leaves open at its end, and what its start
still owes to the split before, are pieces (two a split at most) that are put together afterwards. A file is
read by as many tasks as it has splits, whatever it holds.

A quote inside a cell that is not quoted itself counts too, so files with such cells must be read by lines.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a row is: a whole record, the end of a record of an earlier split, the start of one, a part inside.
WHOLE, HEAD, TAIL, INSIDE = 0, 1, 2, 3
PIECES = "fonte string, bloco long, linha long, tipo int, registro binary"


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Raw lines (bytes without the line feed) with file and start of the split."""
    return (
        spark.read.option("lineSep", "\n")
        .text(list(paths))
        .select(
            F.col("_metadata.file_path").alias("fonte"),
            F.col("_metadata.file_block_start").alias("bloco"),
            F.col("value").cast("binary").alias("registro"),
        )
    )


def open_splits(lines: DataFrame) -> DataFrame:
    """Splits that start inside a quoted cell; at most one row for each split of the input."""
    text = F.col("registro").cast("string")
    quotes = F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))
    counts = lines.groupBy("fonte", "bloco").agg(F.sum(quotes).alias("_n"))
    before = Window.partitionBy("fonte").orderBy("bloco").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.sum("_n").over(before)).where("_before % 2 = 1").select("fonte", "bloco")


class Splitter:
    """Cuts the lines of one split after the other into records; lines come in order."""

    def __init__(self) -> None:
        self.split: tuple | None = None
        self.lines: list[bytes] = []
        self.number = self.first = 0
        self.inside = self.owed = False

    def start(self, split: tuple, inside: bool) -> list[tuple]:
        rows = self.end()
        self.split, self.lines, self.number, self.first = split, [], 0, 0
        self.inside = self.owed = inside
        return rows

    def end(self) -> list[tuple]:
        """What the split leaves open."""
        if self.split is None or not self.lines:
            return []
        kind = INSIDE if self.owed else TAIL
        return [(*self.split, self.first, kind, b"\n".join(self.lines))]

    def add(self, lines: list[bytes], quotes: np.ndarray) -> list[tuple]:
        rows = []
        for line, odd in zip(lines, (quotes % 2).tolist(), strict=True):
            if not self.lines:
                self.first = self.number
            self.lines.append(line)
            self.number += 1
            self.inside ^= bool(odd)
            if not self.inside:
                rows.append((*self.split, self.first, HEAD if self.owed else WHOLE, b"\n".join(self.lines)))
                self.lines, self.owed = [], False
        return rows


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("fonte", pa.string()), ("bloco", pa.int64()), ("linha", pa.int64()), ("tipo", pa.int32()), ("registro", pa.binary())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    splitter = Splitter()
    for batch in batches:
        quotes = pc.count_substring(batch.column("registro"), '"').to_numpy(zero_copy_only=False)
        starts, sources = batch.column("bloco").to_numpy(), batch.column("fonte")
        names = sources.dictionary_encode()
        codes = names.indices.to_numpy()
        # Stretches of one split.
        cuts = np.flatnonzero((starts[1:] != starts[:-1]) | (codes[1:] != codes[:-1])) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(starts)], strict=True):
            if begin == end:
                continue
            split = (names.dictionary[int(codes[begin])].as_py(), int(starts[begin]))
            if split != splitter.split:
                yield batch_of(splitter.start(split, bool(batch.column("_dentro")[begin].as_py())))
            here = batch.slice(begin, end - begin)
            if not splitter.lines and not splitter.inside and not (quotes[begin:end] % 2).any():
                # Every line is a record: the bytes go through as they are.
                n = end - begin
                numbers = pa.array(np.arange(splitter.number, splitter.number + n))
                splitter.number += n
                yield pa.record_batch(
                    [here.column("fonte"), here.column("bloco"), numbers, pa.array(np.full(n, WHOLE, np.int32)), here.column("registro")],
                    schema=schema,
                )
            else:
                yield batch_of(splitter.add(here.column("registro").to_pylist(), quotes[begin:end]))
    yield batch_of(splitter.end())


def read_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Records of the files as bytes: ``fonte``, ``bloco`` and ``linha`` of their first line (they order the
    records of a file), ``registro``. Blank records are left out; a carriage return at the end is taken off."""
    lines = lines_of(spark, paths)
    # At most one row for each input split, and most files have none.
    inside = F.broadcast(open_splits(lines).withColumn("_dentro", F.lit(True)))
    marked = lines.join(inside, ["fonte", "bloco"], "left").withColumn("_dentro", F.coalesce("_dentro", F.lit(False)))
    pieces = marked.mapInArrow(_cut, PIECES)
    whole = pieces.where(F.col("tipo") == WHOLE).drop("tipo")
    rows = whole.unionByName(_put_together(pieces.where(F.col("tipo") != WHOLE)))
    returned = F.expr("substring(registro, -1, 1) = X'0D'")
    text = F.when(returned, F.expr("substring(registro, 1, octet_length(registro) - 1)")).otherwise(F.col("registro"))
    return rows.withColumn("registro", text).where(F.octet_length("registro") > 0)


def _put_together(pieces: DataFrame) -> DataFrame:
    """Records that go over a split border: each starts with the open end of a split."""
    order = Window.partitionBy("fonte").orderBy("bloco", "linha")
    numbered = pieces.withColumn("_numero", F.count_if(F.col("tipo") == TAIL).over(order))
    parts = F.sort_array(F.collect_list(F.struct("bloco", "linha", "registro")))
    grouped = numbered.groupBy("fonte", "_numero").agg(parts.alias("_p"))
    joined = F.aggregate(
        F.expr("slice(_p, 2, size(_p))"),
        F.col("_p")[0]["registro"],
        lambda text, part: F.concat(text, F.lit(b"\n"), part["registro"]),
    )
    return grouped.select("fonte", F.col("_p")[0]["bloco"].alias("bloco"), F.col("_p")[0]["linha"].alias("linha"), joined.alias("registro"))


def cells_of(line: Column) -> Column:
    """Cells of a semicolon-delimited record as written; a quoted cell may hold semicolons and line breaks.

    The pattern gives nothing back once matched, so a quoted cell of any length needs no stack.
    """
    return F.regexp_extract_all(F.concat(F.lit(";"), line), F.lit(r';("[^"]*+(?:""[^"]*+)*+"|[^;]*+)'), F.lit(1))


def unquoted(cell: Column) -> Column:
    """The text of a cell: quotes around it go, doubled quotes inside are one."""
    inner = F.substring(cell, F.lit(2), F.greatest(F.length(cell) - 2, F.lit(0)))
    return F.when(F.startswith(cell, F.lit('"')), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(cell)
