import pytest
from core_helpers import rows
from pyspark.sql import functions as F

from aferir.operators import dedup, reshape


def test_select_mapped_ignores_absent_and_keeps_case_pairs_apart(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("Código da Área", "Código da área", "x.y")
    got = reshape.select_mapped(df, {"Código da área": "lower", "x.y": "dotted", "absent": "z"})
    assert rows(got) == [{"lower": 2, "dotted": 3}]


def test_select_mapped_two_sources_one_target(spark):
    df = spark.createDataFrame([(None, 2), (1, 3)], "QT_DOC int, DOC int")
    got = reshape.select_mapped(df, {"QT_DOC": "qt", "DOC": "qt"})
    assert sorted(r.qt for r in got.collect()) == [1, 2]


def test_rename_keep_and_first_wins(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "A int, B int, Obs int, keep int")
    assert reshape.rename_keep(df, {"A": "a"}).columns == ["a", "B", "Obs", "keep"]
    won = reshape.rename_first_wins(df, {"A": "x", "B": "x", "Obs": "_obs"})
    assert rows(won) == [{"x": 1, "keep": 4}]


def test_canonical_only_and_order(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "z int, Upper int, b int, a int").withColumn("two words", F.lit(1))
    kept = reshape.canonical_only(df)
    assert kept.columns == ["z", "b", "a"]
    assert reshape.keys_first(kept, ["z"]).columns == ["z", "a", "b"]
    assert reshape.suffix_columns(kept, ["a", "absent"], "_atual").columns == ["z", "b", "a_atual"]


def test_row_filters(spark):
    df = spark.createDataFrame([("1", "x"), (None, None), ("Fonte", "y"), (None, "z")], "co string, n string")
    assert reshape.keep_any_value(df).count() == 3
    assert rows(reshape.numeric_code_rows(df, "co")) == [{"co": "1", "n": "x"}]
    assert reshape.require_keys(df, ["co", "n"]).count() == 2
    assert reshape.complete_rows(df).count() == 2
    codes = spark.createDataFrame([(-1,), (5,), (None,)], "co_curso int")
    assert [r.co_curso for r in reshape.identified_only(codes).collect()] == [5]
    assert [r.co_curso for r in reshape.where_code(codes, "co_curso", -1).collect()] == [-1]


@pytest.mark.parametrize(
    "spec, skip, expected",
    [
        ("2023", (), [2023]),
        ("2018,2020-2022", (2020,), [2018, 2021, 2022]),
        (" 2019 , 2018-2019", (), [2018, 2019]),
    ],
)
def test_parse_years(spec, skip, expected):
    assert reshape.parse_years(spec, skip) == expected


def test_parse_years_rejects():
    with pytest.raises(ValueError):
        reshape.parse_years("20x3")
    with pytest.raises(ValueError):
        reshape.parse_years("2008-2010", first=2009)


def test_diagonal_union(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 0.5)], "k int, b double")
    assert rows(reshape.diagonal_union([a, b])) == [
        {"k": 1, "a": "x", "b": None}, {"k": 2, "a": None, "b": 0.5}
    ]


def test_union_of_different_types_needs_canonical_casts(spark):
    a = spark.createDataFrame([("1",)], "k string")
    b = spark.createDataFrame([(2,)], "k bigint")
    both = reshape.diagonal_union([reshape.cast_strict(f, {"k": "bigint"}) for f in (a, b)])
    assert dict(both.dtypes) == {"k": "bigint"} and sorted(r.k for r in both.collect()) == [1, 2]


def test_promote_header_rules(spark):
    data = [
        # Equal headers: the last column counts. Two headers of one target: the first counts.
        ("s1", 1, ["Cod*", "Nome", "Nome", "codigo", "Obs"]),
        ("s1", 2, ["1", "no", "yes", "9", "o"]),
        ("s1", 3, ["2", None, None]),
        ("s2", 1, ["x", None, "CÓD"]),
        ("s2", 2, ["x", "y", "3"]),
    ]
    sheet = spark.createDataFrame(data, "fonte string, linha int, cells array<string>")
    aliases = spark.createDataFrame(
        [("cod", "co"), ("codigo", "co"), ("nome", "no")], "header string, target string"
    )
    first = F.col("linha") == 1
    wide = reshape.promote_header(sheet, first, reshape.header_positions(sheet, first, aliases), ["co", "no"])
    assert rows(wide) == [
        {"fonte": "s1", "linha": 2, "co": "1", "no": "yes"},
        {"fonte": "s1", "linha": 3, "co": "2", "no": None},
        {"fonte": "s2", "linha": 2, "co": "3", "no": None},
    ]


def test_header_can_be_ignored_by_exact_spelling(spark):
    sheet = spark.createDataFrame(
        [("s", 1, ["Nota De X", "Nota de x"]), ("s", 2, ["1", "2"])], "fonte string, linha int, cells array<string>"
    )
    aliases = spark.createDataFrame([("nota de x", "n")], "header string, target string")
    first = F.col("linha") == 1
    at = reshape.header_positions(sheet, first, aliases, ignored={"Nota De X"})
    assert [r.n for r in reshape.promote_header(sheet, first, at, ["n"]).collect()] == ["2"]


def test_fill_from_source(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, 2019), ("a", 3, 2020), ("b", 1, None)], "fonte string, n int, ano int"
    )
    got = reshape.fill_from_source(df, "ano", "n")
    assert sorted((r.fonte, r.n, r.ano or 0) for r in got.collect()) == [
        ("a", 1, 2019), ("a", 2, 2019), ("a", 3, 2020), ("b", 1, 0)
    ]


def test_keep_first_latest_and_any_one(spark):
    df = spark.createDataFrame(
        [(1, 2010, 2, "b"), (1, 2010, 1, "a"), (1, 2011, 3, "c"), (None, 2010, 5, "n"), (None, 2010, 4, "m")],
        "k int, ano int, pos int, v string",
    )
    first = dedup.keep_first(df, ["k", "ano"], ["pos"])
    assert sorted((r.k or 0, r.ano, r.v) for r in first.collect()) == [(0, 2010, "m"), (1, 2010, "a"), (1, 2011, "c")]
    latest = dedup.latest_per_key(df, ["k"], "ano", ["pos"])
    assert sorted((r.k or 0, r.v) for r in latest.collect()) == [(0, "m"), (1, "c")]
    assert dedup.any_one(df, ["k"]).count() == 2
    assert dedup.distinct_rows(df.union(df)).count() == 5


def test_keep_first_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS pos")
    plan = dedup.keep_first(df, ["k"], ["pos"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") or plan.count("WindowGroupLimit") == 2
    assert plan.count("WindowGroupLimit") == 2


def test_year_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "2010 + id % 3 AS ano").write.partitionBy("ano").parquet(path)
    kept = reshape.where_years(spark.read.parquet(path), [2011])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [ano" in plan or "PartitionFilters: [isnotnull(ano" in plan
    assert len(kept.inputFiles()) >= 1 and kept.count() == 3
