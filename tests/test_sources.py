import datetime as dt
import os

import pytest
from bronze import write_text, write_workbook
from core_helpers import rows

from pyspark.sql import functions as F

from aferir.schemas import sheets
from aferir.sinks import refresh
from aferir.sources import delimited, discovery, tables, workbook


def test_delimited_text_tokens_and_order(spark, tmp_path):
    path = write_text(
        tmp_path / "a.csv", "CO;NO_MUNICÍPIO;VT", "1;São Paulo;0000909", "2;NA;", '"3";"a;b";nan', "4;N/A;x"
    )
    df = delimited.read_delimited(spark, str(path))
    assert df.columns == ["CO", "NO_MUNICÍPIO", "VT", "_bloco", "_linha"]
    got = df.orderBy("_bloco", "_linha").collect()
    assert [tuple(r)[:3] for r in got] == [
        ("1", "São Paulo", "0000909"), ("2", None, None), ("3", "a;b", None), ("4", None, "x")
    ]


def test_row_order_survives_splits(spark, tmp_path):
    path = write_text(tmp_path / "big.csv", "N", *[str(i) for i in range(20_000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        df = delimited.read_delimited(spark, str(path))
        assert df.rdd.getNumPartitions() > 3
        assert [int(r.N) for r in df.orderBy("_bloco", "_linha").collect()] == list(range(20_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_multiline_option(spark, tmp_path):
    path = write_text(tmp_path / "m.csv", "A;B", '1;"x', 'y"')
    assert [r.B for r in delimited.read_delimited(spark, str(path), multiline=True).collect()] == ["x\ny"]


WANTED = {"CO_IES": "co_ies", "CO_GRUPO": "co_area", "CO_CURSO": "co_curso", "CO_MUNIC_CURSO": "co_municipio"}


def test_twenty_files_of_mixed_encodings_in_one_scan(spark, tmp_path):
    files, expected = {}, set()
    for i in range(20):
        encoding = ["utf-8", "latin-1", "utf-8-sig"][i % 3]
        header = '"Co_Ies";CO_GRUPO;CO_CURSO;CO_REGIÃO' + (";CO_MUNIC_CURSO" if i % 2 else "")
        end = ";355" if i % 2 else ""
        lines = [f"{i};10;100;São{end}", f"2;;200;y{end}", f"3;30;D1;z{end}"] + [f"{i};10;100;São{end}"] * 4
        files[2000 + i] = str(write_text(tmp_path / str(2000 + i) / "arq 1.txt", header, *lines, encoding=encoding))
        place = 355 if i % 2 else None
        expected |= {(2000 + i, i, 10, 100, place), (2000 + i, 2, None, 200, place), (2000 + i, 3, 30, None, place)}
    files[2030] = str(write_text(tmp_path / "2030" / "arq1.txt", "CO_IES;OUTRA", "1;2"))
    codes, published = delimited.read_codes_of_years(spark, files, WANTED, ["co_ies", "co_area", "co_curso"])
    got = codes.select("ano_fonte", "co_ies", "co_area", "co_curso", "co_municipio").collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)
    assert published[2030] == {"co_ies"} and published[2001] == set(WANTED.values())
    lines, known = delimited.distinct_lines(spark, list(files.values()))
    assert sum(encoding == "ISO-8859-1" for encoding, _ in known.values()) == 7
    assert all(header[3] == "CO_REGIÃO" for _, header in known.values() if len(header) > 3)
    # The merged lines were kept once: no later step scans the files.
    assert "FileScan" not in codes._jdf.queryExecution().executedPlan().toString()
    text = lines.select(delimited.decoded(F.col("registro"), F.col("fonte"), known).alias("t"))
    assert text.where("t LIKE '%São%'").count() == 20


def test_read_header(spark, tmp_path):
    path = write_text(tmp_path / "q.txt", '"NU_ANO";"CO_CURSO";QE_I01', "2010;1;A", encoding="utf-8-sig")
    assert delimited.read_header(spark, str(path)) == ["NU_ANO", "CO_CURSO", "QE_I01"]


def test_workbook_cells(spark, tmp_path):
    path = write_workbook(
        tmp_path / "b.xlsx",
        {
            "Atualizações": [["not", "this"]],
            "Dados": [["Código ", None, "Nota"], [12, "  a & b ", 2.5], [True, None, 3.0], [], [None, None, 1]],
        },
    )
    df = workbook.read_workbooks(spark, [str(path)], sheets.SIDE_SHEETS)
    assert [(r.linha, r.cells) for r in df.orderBy("linha").collect()] == [
        (1, ["Código", None, "Nota"]), (2, ["12", "a & b", "2.5"]), (3, ["True", None, "3.0"]), (4, []),
        (5, [None, None, "1"]),
    ]
    only_side = write_workbook(tmp_path / "c.xlsx", {"Plan2": [["x"]]})
    assert workbook.read_workbooks(spark, [str(only_side)], sheets.SIDE_SHEETS).count() == 1


STYLES = (
    '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><numFmts>'
    '<numFmt numFmtId="164" formatCode="dd/mm/yyyy"/><numFmt numFmtId="165" formatCode="[$-416]d&quot; de &quot;mmmm"/>'
    '<numFmt numFmtId="166" formatCode="0.00&quot; dias&quot;"/><numFmt numFmtId="167" formatCode="[h]:mm:ss"/>'
    '<numFmt numFmtId="168" formatCode="yyyy\\-mm\\-dd hh:mm"/><numFmt numFmtId="169" formatCode="[Red]#,##0;[Black]-0"/></numFmts>'
    "<cellStyleXfs><xf numFmtId=\"14\"/></cellStyleXfs><cellXfs>"
    + "".join(f'<xf numFmtId="{n}"/>' for n in (0, 14, 164, 165, 166, 167, 168, 169, 22, 21))
    + "</cellXfs></styleSheet>"
)


def styled_workbook(path, cells, epoch=""):
    import zipfile

    write_workbook(path, {"Dados": [["x"]]})
    row = "".join(f'<c r="{chr(65 + i)}1" s="{s}"><v>{v}</v></c>' for i, (s, v) in enumerate(cells))
    with zipfile.ZipFile(path) as book:
        parts = {name: book.read(name) for name in book.namelist()}
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    sheet = f'<worksheet xmlns="{main}"><sheetData><row r="1">{row}</row></sheetData></worksheet>'
    parts["xl/worksheets/sheet1.xml"] = sheet.encode()
    parts["xl/styles.xml"] = STYLES.encode()
    parts["xl/workbook.xml"] = parts["xl/workbook.xml"].replace(b"<sheets>", epoch.encode() + b"<sheets>")
    with zipfile.ZipFile(path, "w") as book:
        for name, data in parts.items():
            book.writestr(name, data)
    return str(path)


def test_date_cells(spark, tmp_path):
    cells = [
        (0, "43831"), (1, "43831"), (2, "1"), (3, "59"), (1, "60"), (1, "61"), (4, "12.5"), (5, "1.5"),
        (6, "43831.75"), (7, "43831"), (8, "43831.999999"), (9, "0.5"), (2, "43831.25"),
    ]
    expected = [
        "43831", "2020-01-01", "1900-01-01", "1900-02-28", "1900-02-29", "1900-03-01", "12.5", "36:00:00",
        "2020-01-01 18:00:00", "43831", "2020-01-02 00:00:00", "12:00:00", "2020-01-01 06:00:00",
    ]
    path = styled_workbook(tmp_path / "d.xlsx", cells)
    assert workbook.read_workbooks(spark, [path], ()).first().cells == expected
    later = styled_workbook(tmp_path / "e.xlsx", [(1, "42369"), (1, "0")], '<workbookPr date1904="1"/>')
    assert workbook.read_workbooks(spark, [later], ()).first().cells == ["2020-01-01", "1904-01-01"]


def test_discovery_prefers_year_then_xlsx(spark, tmp_path):
    base = tmp_path / "bronze" / "cpc"
    for name in ("2019/b.xlsx", "2019/a.xlsx", "2019/cpc_2019.XLSX", "2021/x.xlsx", "2021/notes.txt", "2022/y.xls"):
        write_text(base / name, "x")
    found = discovery.find_files(spark, str(tmp_path / "bronze"), "cpc", r".*\.xlsx?", range(2019, 2023))
    assert len(found) == 5
    chosen = discovery.one_per_year(found)
    assert [tables.file_name(f.path) for f in chosen.values()] == ["cpc_2019.XLSX", "x.xlsx", "y.xls"]
    with pytest.raises(FileNotFoundError):
        discovery.find_files(spark, str(tmp_path / "bronze"), "absent", ".*", [2019])


def test_silver_refresh_replaces_only_stale_years(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows_of = lambda year, v: spark.createDataFrame([(v, year)], "v int, ano_fonte int")
    refresh.write_silver(rows_of(2019, 1).union(rows_of(2020, 2)), path)
    names = [f.name for f in (tmp_path / "silver" / "ano_fonte=2019").iterdir()]
    assert any(n.endswith(".zstd.parquet") for n in names)
    refresh.write_silver(rows_of(2020, 3).union(rows_of(2019, 9)), path, replace_years=[2020])
    assert {(r.ano_fonte, r.v) for r in spark.read.parquet(path).collect()} == {(2019, 1), (2020, 3)}

    now = dt.datetime.now()
    manifest = spark.createDataFrame(
        [(2019, now - dt.timedelta(days=1)), (2020, now + dt.timedelta(days=1)), (2021, now)],
        "ano int, modificado timestamp",
    )
    written = discovery.output_manifest(spark, path)
    assert sorted(r.ano for r in refresh.stale_years(manifest, written).collect()) == [2020, 2021]
    assert refresh.stale_years(manifest, written, force=True).count() == 3
    assert refresh.stale_years(manifest, None).count() == 3
    assert discovery.output_manifest(spark, str(tmp_path / "absent")) is None


def test_gold_write_is_sorted_and_readable(spark, tmp_path):
    path = str(tmp_path / "gold")
    df = spark.range(100).selectExpr("99 - id AS k", "id AS v")
    refresh.write_gold(df, path, ["k"])
    assert tables.read_table(spark, path).count() == 100
    folder = os.path.join(path, tables.manifests(spark, path)[-1][1])
    part = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))[0]
    keys = [r.k for r in spark.read.parquet(os.path.join(folder, part)).collect()]
    assert keys == sorted(keys)
    assert [r.k for r in refresh.preview(df, ["k"], 3).collect()] == [0, 1, 2]
    refresh.write_gold(df.where("k < 5"), path, ["k"])  # replaces the table and leaves nothing beside it
    assert tables.read_table(spark, path).count() == 5 and sorted(os.listdir(tmp_path)) == ["gold"]


def test_readers_keep_their_version_and_old_ones_go(spark, tmp_path):
    path = str(tmp_path / "gold")
    refresh.write_gold(spark.range(1), path, ["id"])
    begun = tables.read_table(spark, path)
    refresh.write_gold(spark.range(2), path, ["id"])
    assert (begun.count(), tables.read_table(spark, path).count()) == (1, 2)
    for n in (3, 4, 5):
        refresh.write_gold(spark.range(n), path, ["id"])
    assert tables.read_table(spark, path).count() == 5
    assert len(os.listdir(os.path.join(path, tables.VERSIONS))) == 2 == len(tables.manifests(spark, path))


@pytest.mark.parametrize("step", ["rows", "manifest", "rename", "cleaning"])
def test_a_failed_write_leaves_a_readable_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "gold")
    refresh.write_gold(spark.range(3), path, ["id"])

    def fail(*args, **kwargs):
        raise OSError("lost")

    if step == "rows":
        rows_of = spark.range(9).selectExpr("CASE WHEN id = 7 THEN raise_error('lost') ELSE id END AS id")
    else:
        rows_of = spark.range(9)
    if step == "manifest":
        monkeypatch.setattr(refresh, "commit_version", fail)
    if step == "rename":
        # Another writer takes the next number between the listing and the rename.
        monkeypatch.setattr(refresh, "manifests", lambda *_: [])
    if step == "cleaning":
        monkeypatch.setattr(refresh, "remove_old_versions", fail)
    with pytest.raises(Exception, match="lost|another writer"):
        refresh.write_gold(rows_of, path, ["id"])
    monkeypatch.undo()
    assert tables.read_table(spark, path).count() == (9 if step == "cleaning" else 3)
    refresh.write_gold(spark.range(4), path, ["id"])
    assert tables.read_table(spark, path).count() == 4


def test_layout_sizes():
    from aferir.schemas import census, common, enade

    sizes = {
        "institution": (census.INSTITUTION, 31, 31), "staff": (census.STAFF, 89, 58),
        "course": (census.COURSE, 74, 74), "arq1": (enade.COURSE_FILE, 11, 10), "arq3": (enade.STUDENT_FILE, 52, 52),
    }
    for name, (layout, headers, columns) in sizes.items():
        assert (len(layout.headers), len(layout.columns)) == (headers, columns), name
    assert len(common.EXAM_YEARS) == 19 and 2020 not in common.EXAM_YEARS
    assert [len(layout.columns) for layout in (sheets.CPC, sheets.IDD, sheets.IGC)] == [40, 23, 17]


def test_fallback_looks_at_the_values(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_bytes("CO_IES;NOME\n1;São\n".encode("latin-1"))
    assert [r.NOME for r in delimited.read_with_fallback(spark, str(path)).collect()] == ["São"]
    path.write_bytes("CO_IES;NOME\n1;São\n".encode())
    assert [r.NOME for r in delimited.read_with_fallback(spark, str(path)).collect()] == ["São"]


def test_cells_may_hold_the_separator(spark):
    lines = spark.createDataFrame([('"a;b";;"c""d";e',), ("",), (";x",), (None,)], "v string")
    got = [r.c for r in lines.select(delimited.cells_of(F.col("v")).alias("c")).collect()]
    assert got == [['"a;b"', "", '"c""d"', "e"], [""], ["", "x"], None]
