import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aferir.functions import values as V


def column(spark, values, expression, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {ddl}")
    out = df.select("i", expression(F.col("c")).alias("r")).orderBy("i").collect()
    return [r.r for r in out]


def test_strip_text_handles_tabs_and_no_break_spaces(spark):
    assert column(spark, ["\t a b ", " x", None], V.strip_text) == ["a b", "x", None]
    assert column(spark, ['" 12" ', '"x"'], V.strip_quotes) == ["12", "x"]


def test_null_tokens(spark):
    assert column(spark, ["", "NA", "N/A", "nan", "NaN", "0", None], V.drop_null_tokens) == [
        None, None, None, None, "NaN", "0", None
    ]


def test_only_digits_rejects_trailing_newline(spark):
    assert column(spark, ["12", "12\n", "1a", "", "٣", None], V.only_digits) == [
        True, False, False, False, False, None
    ]


def test_decode_unknown_and_null(spark):
    assert column(spark, [1, 9, None], lambda c: V.decode(c, {1: "a", 2: "b"}), "int") == ["a", None, None]


def test_network_of_category(spark):
    assert column(spark, [1, 3, 4, None], V.network_of_category, "int") == [1, 1, 2, 2]


def test_cebas(spark):
    texts = ["X", "-", "Sim", "não", "outro", "", None]
    assert column(spark, texts, V.cebas_flag) == [True, False, None, None, None, None, None]
    assert column(spark, texts, V.cebas_code) == [None, 0, 1, 0, None, 0, None]


def test_no_grade_flag_is_three_valued(spark):
    cases = [
        ("SC", None, True), (" SC ", "x", True), ("3", "note", False), ("", "note", True),
        (None, "note", True), (None, " ", None), (None, None, None), ("None", "note", True),
        ("", None, False), (None, "None", None), ("SC ", "None", True),
    ]
    df = spark.createDataFrame([(i, b, r) for i, (b, r, _) in enumerate(cases)], "i int, b string, r string")
    flag = V.no_grade_flag(F.col("b"), F.col("r"))
    got = df.select("i", flag.alias("f"), V.hide_when(flag, F.col("b")).alias("h")).orderBy("i").collect()
    assert [r.f for r in got] == [c[2] for c in cases]
    assert [r.h for r in got] == [None if c[2] else c[0] for c in cases]


def test_fallback_flag(spark):
    df = spark.createDataFrame(
        [(0, 1, None), (1, None, None), (2, 2, " "), (3, 2, "note"), (4, 2, "None")], "i int, b int, r string"
    )
    flag = V.fallback_no_grade_flag(F.col("b"), F.col("r"))
    assert [r.f for r in df.select("i", flag.alias("f")).orderBy("i").collect()] == [
        False, True, False, True, False
    ]
    assert df.select(V.fallback_no_grade_flag(None, None).alias("f")).first().f is False


def test_outlier_repair_needs_every_condition(spark):
    cases = [
        (1.0, None, 1, False, 0.0), (None, None, 1, False, None), (1.0, 2.0, 1, False, 2.0),
        (1.0, None, 2, False, None), (1.0, None, 1, True, None), (1.0, None, 1, None, None),
    ]
    df = spark.createDataFrame(
        [(i, *c[:4]) for i, c in enumerate(cases)], "i int, raw double, c double, band int, f boolean"
    )
    repaired = V.repair_outlier(F.col("raw"), F.col("c"), F.col("band"), F.col("f"))
    assert [r.x for r in df.select("i", repaired.alias("x")).orderBy("i").collect()] == [c[4] for c in cases]


def test_ratio_and_rounding(spark):
    df = spark.createDataFrame([(1, 2), (1, 0)], "a int, b int")
    assert [r[0] for r in df.select(V.ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None]
    assert column(spark, [6.25], V.round_half_even, "double") == [6.2]


def test_casts_strict_and_lenient(spark):
    from aferir.operators.reshape import cast_lenient, cast_strict

    df = spark.createDataFrame([("12",), ("x",), (" 7 ",), ("45,3",), ("12.0",)], "c string")
    got = [r.c for r in cast_lenient(df, {"c": "int", "absent": "int"}).collect()]
    assert got == [12, None, 7, None, None]
    with pytest.raises(PySparkException):
        cast_strict(df, {"c": "int"}).collect()


@pytest.mark.parametrize("ddl", ["int", "bigint", "float", "double"])
def test_lenient_cast_equals_try_cast(spark, ddl):
    from aferir.operators.reshape import cast_lenient

    texts = ["1", " 1", "1\t\n", "+5", "-5", "- 5", "1.0", "1.", ".5", "1e3", "1E-2", "0x1", "1L", "1d", "1f", "NaN", "nan",
             "Infinity", "-inf", "inf", "SC", "-", "", " ", "1,5", "99999999999", "9" * 30, "٣", "1\u00a0", "\u00a01", "\x7f1",
             "\x001\x1f", "1_0", "true", "1 2", "+-1", "1\u2003", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    ours = [str(r.c) for r in cast_lenient(df, {"c": ddl}).collect()]
    assert ours == [str(r.c) for r in df.select(F.col("c").try_cast(ddl).alias("c")).collect()]


def test_fold_header(spark):
    texts = ["Código da IES*", "CÓDIGO  da ies ", "Sigla da UF** ", "Gama (Proporção – X)", "Código"]
    assert column(spark, texts, V.fold_header) == [
        "codigo da ies", "codigo da ies", "sigla da uf", "gama (proporcao - x)", "codigo"
    ]


def test_typed_null_and_fill(spark):
    row = spark.range(1).select(V.typed_null("bigint").alias("a"), V.fill(F.lit(None), 7).alias("b"))
    assert dict(row.dtypes)["a"] == "bigint" and row.first().b == 7
    assert spark.range(1).select(V.first_filled(F.lit(None), F.lit(3)).alias("x")).first().x == 3
    assert spark.range(1).select(V.abs_diff(F.lit(2), F.lit(5)).alias("x")).first().x == 3
