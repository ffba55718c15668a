"""Small raw files for the end-to-end tests."""

from __future__ import annotations

import zipfile
from pathlib import Path
from xml.sax.saxutils import escape


def write_text(path: Path, header: str, *lines: str, encoding: str = "latin-1") -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(("\n".join([header, *lines]) + "\n").encode(encoding))
    return path


def _letters(i: int) -> str:
    name = ""
    i += 1
    while i:
        i, rest = divmod(i - 1, 26)
        name = chr(65 + rest) + name
    return name


def _cell(reference: str, value, shared: list[str]) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{reference}"><v>{value}</v></c>'
    if value not in shared:
        shared.append(value)
    return f'<c r="{reference}" t="s"><v>{shared.index(value)}</v></c>'


def write_workbook(path: Path, sheets: dict[str, list[list]]) -> Path:
    """A workbook with one sheet per entry, rows of Python values, texts in the shared table."""
    path.parent.mkdir(parents=True, exist_ok=True)
    shared: list[str] = []
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as book:
        names, relations = [], []
        for n, (name, rows) in enumerate(sheets.items(), 1):
            body = "".join(
                f'<row r="{r}">'
                + "".join(_cell(f"{_letters(i)}{r}", v, shared) for i, v in enumerate(row))
                + "</row>"
                for r, row in enumerate(rows, 1)
            )
            book.writestr(
                f"xl/worksheets/sheet{n}.xml",
                f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
            )
            names.append(f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>')
            relations.append(f'<Relationship Id="rId{n}" Type="t" Target="worksheets/sheet{n}.xml"/>')
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{links}"><sheets>{"".join(names)}</sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f'{"".join(relations)}</Relationships>',
        )
        items = "".join(f"<si><t xml:space=\"preserve\">{escape(s)}</t></si>" for s in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')
    return path
