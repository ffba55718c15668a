"""Workbooks (.xlsx) as rows of text cells.

Spark distributes the files; one task decodes one file as a stream. Choosing columns, promoting the
header row and typing are DataFrame operations on the result.
"""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree.ElementTree import iterparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from aferir.operators.reshape import header_positions, promote_header
from aferir.schemas.layout import Layout
from aferir.session import materialise

ROW_SCHEMA = "fonte string, linha int, cells array<string>"
ROWS_PER_BATCH = 5_000


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _text(node) -> str:
    """Text runs below a node, without phonetic hints."""
    parts = []
    for child in node:
        kind = _local(child.tag)
        if kind == "t":
            parts.append(child.text or "")
        elif kind == "r":
            parts.append(_text(child))
    return "".join(parts)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    found = []
    with book.open("xl/sharedStrings.xml") as stream:
        for _, node in iterparse(stream):
            if _local(node.tag) == "si":
                found.append(_text(node))
                node.clear()
    return found


def _data_sheet(book: zipfile.ZipFile, skip: Sequence[str]) -> str:
    """Part name of the first sheet that is not a side sheet, or of the first sheet."""
    parts = {}
    with book.open("xl/_rels/workbook.xml.rels") as stream:
        for _, node in iterparse(stream):
            if _local(node.tag) == "Relationship":
                target = node.get("Target")
                parts[node.get("Id")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    sheets = []
    with book.open("xl/workbook.xml") as stream:
        for _, node in iterparse(stream):
            if _local(node.tag) == "sheet":
                link = next(v for k, v in node.attrib.items() if _local(k) == "id" and k != "id")
                sheets.append((node.get("name"), parts[link]))
    return next((part for name, part in sheets if name not in skip), sheets[0][1])


def _column(reference: str) -> int:
    number = 0
    for letter in reference.rstrip("0123456789"):
        number = number * 26 + ord(letter) - 64
    return number - 1


# Numbers of the built-in formats of dates and of times of day.
DATE_FORMATS = frozenset([*range(14, 18), 22, *range(27, 37), *range(50, 59)])
TIME_FORMATS = frozenset([*range(18, 23), *range(45, 48)])
#: What does not count as a date or time letter in a format: quoted and escaped texts, colours, padding.
LITERAL = re.compile(r'"[^"]*"|\\.|[_*].|\[(?!h+\]|m+\]|s+\])[^\]]*\]', re.IGNORECASE)


def _kind_of_format(number: int, code: str | None) -> str:
    """Letters d and t: a number with this format shows a date, a time of day, both, or neither."""
    if code is None:
        return "d" * (number in DATE_FORMATS) + "t" * (number in TIME_FORMATS)
    letters = LITERAL.sub("", code.split(";")[0]).lower()
    if "general" in letters or not re.search("[dmyhs]", letters):
        return ""
    # An m beside hours or seconds is minutes.
    clock = re.search("[hs]", letters)
    date = re.search("[dy]", letters) or ("m" in letters and not clock)
    return "d" * bool(date) + "t" * bool(clock)


def _cell_styles(book: zipfile.ZipFile) -> list[str]:
    """Kind of every cell style of the workbook, by its number."""
    if "xl/styles.xml" not in book.namelist():
        return []
    codes: dict[int, str] = {}
    styles: list[str] = []
    with book.open("xl/styles.xml") as stream:
        for _, node in iterparse(stream):
            if _local(node.tag) == "numFmt":
                codes[int(node.get("numFmtId"))] = node.get("formatCode", "")
            elif _local(node.tag) == "cellXfs":
                used = [int(x.get("numFmtId", 0)) for x in node if _local(x.tag) == "xf"]
                styles = [_kind_of_format(n, codes.get(n)) for n in used]
    return styles


def _first_day(book: zipfile.ZipFile) -> int:
    """Serial number of 1900-01-01 less one in the workbook's calendar: 0, or -1462 with the 1904 epoch."""
    with book.open("xl/workbook.xml") as stream:
        for _, node in iterparse(stream):
            if _local(node.tag) == "workbookPr":
                return -1462 if node.get("date1904", "0") in ("1", "true") else 0
    return 0


def _moment(serial: float, kind: str, epoch: int) -> str:
    """Text of a serial day: date, time of day, or both; the year 1900 counts a 29 February it did not have."""
    day, rest = divmod(serial, 1)
    seconds = round(rest * 86_400)
    if seconds == 86_400:
        day, seconds = day + 1, 0
    clock = f"{seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"
    day = int(day) - epoch
    if "d" not in kind:
        return clock if 0 <= serial < 1 else f"{int(serial) * 24 + seconds // 3600:02d}{clock[2:]}"
    if day == 60:
        date = "1900-02-29"
    else:
        date = (datetime.date(1899, 12, 30 if day > 60 else 31) + datetime.timedelta(day)).isoformat()
    return f"{date} {clock}" if "t" in kind or seconds else date


def _cell(node, shared: list[str], styles: Sequence[str] = (), epoch: int = 0) -> str | None:
    """Cell value as trimmed text: whole numbers without decimals, booleans as True / False, and numbers
    that the cell's style shows as a date or time as ISO text."""
    kind = node.get("t", "n")
    if kind == "inlineStr":
        inline = next((c for c in node if _local(c.tag) == "is"), None)
        return None if inline is None else _text(inline).strip()
    raw = next((c.text for c in node if _local(c.tag) == "v"), None)
    if raw is None:
        return None
    if kind == "s":
        return shared[int(raw)].strip()
    if kind == "b":
        return str(raw == "1")
    if kind == "n":
        style = int(node.get("s", 0))
        if style < len(styles) and styles[style] and 0 <= float(raw) < 2_958_466:
            return _moment(float(raw), styles[style], epoch)
        return str(float(raw)) if any(c in raw for c in ".eE") else str(int(raw))
    return raw.strip()


def _rows(content: bytes, skip: Sequence[str]) -> Iterator[tuple[int, list[str | None]]]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared, styles, epoch = _shared_strings(book), _cell_styles(book), _first_day(book)
        with book.open(_data_sheet(book, skip)) as stream:
            number = 0
            for _, node in iterparse(stream):
                if _local(node.tag) != "row":
                    continue
                number = int(node.get("r", number + 1))
                cells: list[str | None] = []
                for c in node:
                    at = _column(c.get("r")) if c.get("r") else len(cells)
                    cells.extend([None] * (at - len(cells)))
                    cells.append(_cell(c, shared, styles, epoch))
                yield number, cells
                node.clear()


def read_workbooks(spark: SparkSession, paths: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """Rows of the data sheet of every workbook: source path, row number from 1, cells as text."""
    skip = tuple(skip)

    def decode(batches):
        for files in batches:
            for path, content in zip(files["path"], files["content"]):
                pending = []
                for number, cells in _rows(content, skip):
                    pending.append((path, number, cells))
                    if len(pending) == ROWS_PER_BATCH:
                        yield pd.DataFrame(pending, columns=["fonte", "linha", "cells"])
                        pending = []
                if pending:
                    yield pd.DataFrame(pending, columns=["fonte", "linha", "cells"])

    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    return files.repartition(len(paths)).mapInPandas(decode, ROW_SCHEMA)


def read_sheets(
    spark: SparkSession, paths: Sequence[str], layout: Layout, skip: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, set[str]]]:
    """Canonical text columns of many workbooks, and the columns each workbook publishes.

    Sources with different headers go through one plan. The decoded rows are written once, so the
    header and the data pass do not decode the files again; the wide texts are written once, so
    later plans start from plain columns.
    """
    rows = materialise(read_workbooks(spark, paths, skip))
    header = rows["linha"] == 1
    positions = header_positions(rows, header, layout.aliases(spark), layout.ignored)
    # One row per workbook with at most as many names as the layout has columns.
    published = {r.fonte: set(r.positions) for r in positions.collect()}
    columns = [c for c in layout.columns if not c.startswith("_")]
    return materialise(promote_header(rows, header, positions, columns)), published
