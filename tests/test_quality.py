"""Every gate with one passing and one failing input."""

import pytest
from core_helpers import rows
from pyspark.sql import functions as F

from aferir.operators import quality as Q


@pytest.fixture
def good(spark):
    return spark.createDataFrame([(1, 10, 5, 3), (2, 20, 4, 4)], "k int, v int, a int, b int")


@pytest.fixture
def bad(spark):
    return spark.createDataFrame([(1, 10, 5, 6), (1, 200, 4, 4), (None, 5, 1, 1)], "k int, v int, a int, b int")


def checks():
    return [Q.not_empty(), Q.no_nulls("k"), Q.in_range("v", 0, 100), Q.row_rule("b<=a", F.col("b") <= F.col("a"))]


def test_checks_pass_and_fail(good, bad):
    Q.enforce(Q.run_checks(good, checks()))
    report = {r["check"]: r["violations"] for r in Q.run_checks(bad, checks()).collect()}
    assert report == {"not_empty": 0, "no_nulls:k": 1, "in_range:v": 1, "row_rule:b<=a": 1}
    with pytest.raises(Q.ValidationError):
        Q.enforce(Q.run_checks(bad, checks()), "bad")


def test_empty_table_fails(good):
    with pytest.raises(Q.ValidationError):
        Q.enforce(Q.run_checks(good.where("k > 9"), [Q.not_empty()]))


def test_required_columns_and_types(good):
    Q.require_columns(good, ["k", "v"])
    Q.require_types(good, {"k": "int"})
    with pytest.raises(Q.ValidationError):
        Q.require_columns(good, ["absent"])
    with pytest.raises(Q.ValidationError):
        Q.require_types(good, {"k": "bigint"})


def test_required_for_year():
    absent = {"co_curso": range(2007, 2017), "faixa": (2007, 2008)}
    required = ["ano", "faixa", "co_curso"]
    assert Q.required_for_year(required, 2007, absent) == ["ano"]
    assert Q.required_for_year(required, 2016, absent) == ["ano", "faixa"]
    assert Q.required_for_year(required, 2017, absent) == required


def test_primary_key(good, bad):
    assert Q.pk_duplicates(good, ["k"]).isEmpty() and Q.pk_report(good, ["k"]).first().ok
    assert rows(Q.pk_duplicates(bad, ["k"])) == [{"k": 1, "n": 2}]
    report = Q.pk_report(bad, ["k"]).first()
    assert (report.linhas, report.chaves, report.duplicatas, report.ok) == (3, 2, 1, False)


def test_foreign_key(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    report = Q.fk_report(child, parent, "k", 30).first()
    assert (report.chaves, report.orfas, report.pct, report.ok) == (4, 1, 25.0, True)
    assert not Q.fk_report(child, parent, "k", 25).first().ok
    assert rows(Q.orphan_keys(child, parent, "k")) == [{"k": 4}]


def test_year_coverage(spark):
    df = spark.createDataFrame([(2018,), (2019,), (2019,), (2020,)], "ano int")
    got = {r.ano: (r.esperado, r.linhas, r.ok) for r in Q.year_coverage(df, [2018, 2019, 2021], [2020]).collect()}
    assert got == {2018: (True, 1, True), 2019: (True, 2, True), 2020: (False, 1, False), 2021: (True, 0, False)}


def test_reconcile(spark):
    a = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None), (4, 1.0)], "k int, x double")
    b = spark.createDataFrame([(1, 10.2), (2, 19.9), (3, 5.0)], "k int, y double")
    close = Q.reconcile(a, b, ["k"], "x", "y", 0.5, 1.0).first()
    assert close.n == 2 and close.ok and close.max_dif == pytest.approx(0.2)
    assert not Q.reconcile(a, b, ["k"], "x", "y", 0.1, 1.0).first().ok
    assert Q.reconcile(a, b.where("k > 9"), ["k"], "x", "y", 0.1, 1.0).first().ok is None


def test_errors_state_the_true_number(spark):
    report = spark.range(250).selectExpr("id AS check", "false AS ok")
    with pytest.raises(Q.ValidationError, match="250 failures"):
        Q.enforce(report)


def test_layer_totals(spark):
    gold = spark.createDataFrame([(2,), (1,)], "n int")
    silver = spark.createDataFrame([(555,), (555,), (555,), (222,)], "p int")
    assert Q.layer_totals(gold, "n", silver, F.col("p") == 555).first().ok
    assert not Q.layer_totals(gold, "n", silver, F.col("p") == 222).first().ok


def test_schema_drift(spark):
    df = spark.createDataFrame([(2010, 1, None), (2011, 2, "x"), (2011, 3, None)], "ano int, a int, b string")
    got = Q.schema_drift(Q.filled_columns(df, ["a", "b"])).collect()
    assert [(r.coluna, r.n_anos, r.anos) for r in got] == [("a", 2, "2010,2011"), ("b", 1, "2011")]
