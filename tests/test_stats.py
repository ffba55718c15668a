import pytest
from core_helpers import rows
from pyspark.sql import functions as F

from aferir.operators import lookup, stats


GIVEN = {"q1": ["A", "B"], "q2": ["A", "C"]}


def test_answer_profile_zero_and_null(spark):
    """Zero: respondents but not this answer. Null: no respondents, or an answer unseen in the year."""
    data = [
        (2010, "c1", "q1", "A"), (2010, "c1", "q1", "A"), (2010, "c1", "q1", "B"), (2010, "c1", "q1", None),
        (2010, "c2", "q1", "B"), (2010, "c2", "q2", "A"), (2010, "c3", "q2", None),
        (2011, "c1", "q1", "A"), (2011, "c1", "q2", "C"),
    ]
    df = spark.createDataFrame(data, "ano int, curso string, questao string, resposta string")
    got = {(r.ano, r.curso): r for r in stats.answer_profile(df, "ano", ["curso"], GIVEN).collect()}
    assert set(got) == {(2010, "c1"), (2010, "c2"), (2011, "c1")}
    one, two, later = got[2010, "c1"], got[2010, "c2"], got[2011, "c1"]
    assert (one.q1_respondentes, one.q1_A, one.q1_B) == (3, pytest.approx(2 / 3), pytest.approx(1 / 3))
    assert (one.q2_respondentes, one.q2_A, one.q2_C) == (None, None, None)
    assert (two.q1_A, two.q1_B, two.q2_A, two.q2_C) == (0.0, 1.0, 1.0, None)
    assert (later.q1_A, later.q1_B, later.q2_A, later.q2_C) == (1.0, None, None, 1.0)


def test_long_profile_has_no_bound(spark):
    df = spark.range(9_000).selectExpr("1 AS ano", "id % 3 AS u", "'q' AS questao", "string(id) AS resposta")
    got = stats.answer_shares(df, "ano", ["u"])
    assert got.count() == 9_000 and got.where("respondentes <> 3000 OR abs(parte * 3000 - 1) > 1e-9").isEmpty()


def test_answers_outside_the_list_count_as_respondents(spark):
    df = spark.createDataFrame([(1, "u", "q", "A"), (1, "u", "q", "odd")], "ano int, u string, questao string, resposta string")
    row = stats.answer_profile(df, "ano", ["u"], {"q": ["A", "B"]}).first()
    assert (row.q_respondentes, row.q_A, row.q_B) == (2, 0.5, None)


def test_columns_that_would_merge_are_refused():
    with pytest.raises(ValueError):
        stats.profile_columns({"a": ["b_c"], "a_b": ["c"]})


def test_summaries(spark):
    df = spark.createDataFrame(
        [(1, 10, 2010, 3, 50.0), (1, 11, 2010, 0, None), (2, 10, 2012, 5, 70.0)],
        "co_ies int, co_curso int, ano int, qt_presentes int, nota double",
    )
    one = stats.build_summary(df, {"ies": "co_ies"}, {"vazios": F.col("qt_presentes") == 0}, ["nota"]).first()
    assert (one.linhas, one.ies, one.anos, one.vazios, one.nota_nulos) == (3, 2, "2010,2012", 1, 1)
    assert one.nota_preenchido_pct == pytest.approx(200 / 3)
    years = stats.year_summary(df, "nota").collect()
    assert [(r.ano, r.media_geral, r.total_presentes, r.cursos) for r in years] == [(2010, 50.0, 3, 1), (2012, 70.0, 5, 1)]
    spread = stats.value_range(df, ["nota", "ano"]).collect()
    assert [(r.coluna, r.minimo, r.maximo) for r in spread] == [("nota", 50.0, 70.0), ("ano", 2010.0, 2012.0)]


MICRO = [
    # (ies, area, municipio, curso)
    (1, 10, 5, 100),            # unambiguous pair
    (2, 10, 5, 200), (2, 10, 6, 201),  # ambiguous pair, unambiguous places
    (3, 10, 5, 300), (3, 10, 5, 301),  # ambiguous everywhere
    (4, 10, None, 400), (4, 10, 5, 401),  # the row with a null place does not count
]


@pytest.mark.parametrize("salts", [1, 8])
def test_cascade(spark, salts):
    micro = spark.createDataFrame([(2015, *m) for m in MICRO], "ano int, co_ies int, co_area int, co_municipio int, co_curso bigint")
    direct = spark.createDataFrame([(2015, 1, 10, 5, 999), (2015, 3, 10, 5, 7), (2015, 3, 10, 5, 8)], micro.schema)
    base = spark.createDataFrame(
        [(2015, 1, 10, 5), (2015, 1, 10, 6), (2015, 2, 10, 6), (2015, 2, 10, None), (2015, 3, 10, 5),
         (2015, 4, 10, 9), (2016, 1, 10, 5), (2015, None, 10, 5)],
        "ano int, co_ies int, co_area int, co_municipio int",
    )
    got = lookup.enrich_codes(base, micro, direct, salts=salts)
    found = {(r.ano, r.co_ies, r.co_municipio): r.co_curso for r in got.collect()}
    assert found == {
        (2015, 1, 5): 999, (2015, 1, 6): 100, (2015, 2, 6): 201, (2015, 2, None): None,
        (2015, 3, 5): None, (2015, 4, 9): 401, (2016, 1, 5): None, (2015, None, 5): None,
    }
    assert got.count() == base.count()


def test_cascade_keeps_known_codes_and_works_without_place(spark):
    base = spark.createDataFrame([(2015, 1, 10, 1), (2015, 2, 10, None)], "ano int, co_ies int, co_area int, co_curso bigint")
    micro = spark.createDataFrame([(2015, 1, 10, 9), (2015, 2, 10, 8)], "ano int, co_ies int, co_area int, co_curso bigint")
    assert {r.co_ies: r.co_curso for r in lookup.enrich_codes(base, micro).collect()} == {1: 1, 2: 8}


@pytest.mark.parametrize("salts", [1, 3, 8])
def test_lookup_join_never_multiplies(spark, salts):
    facts = spark.createDataFrame([("1", 1), ("1", 2), ("2", 3), (None, 4)], "k string, v int")
    look = spark.createDataFrame([("1", "a"), ("1", "a"), ("1", "b"), (None, "n")], "k string, name string")
    got = lookup.lookup_join(facts, look, ["k"], ["name"], salts=salts)
    assert {r.v: r.name for r in got.collect()} == {1: "a", 2: "a", 3: None, 4: None}


def test_unambiguous(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 5), (2, 6), (3, None)], "k int, c int")
    assert rows(lookup.unambiguous(df, ["k"], "c", "code")) == [{"k": 1, "code": 5}]


def test_cascade_shuffles_the_micro_data_once(spark, tmp_path):
    path = str(tmp_path / "micro")
    spark.createDataFrame([(2015, *m) for m in MICRO], "ano int, co_ies int, co_area int, co_municipio int, co_curso bigint").write.parquet(path)
    base = spark.createDataFrame([(2015, 1, 10, 5)], "ano int, co_ies int, co_area int, co_municipio int")
    got = lookup.enrich_codes(base, spark.read.parquet(path))
    got.collect()
    # Both levels come from one aggregate, so one scan feeds them.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and plan.count("Join") == 1


def test_hot_key_is_spread(spark):
    """All rows share one key; without broadcasts they still meet the lookup in several tasks."""
    facts = spark.range(8_000).selectExpr("1 AS k", "id")
    look = spark.range(1).selectExpr("1 AS k", "'x' AS name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = lookup.lookup_join(facts, look, ["k"], ["name"]).withColumn("p", F.spark_partition_id())
        assert got.where("name = 'x'").count() == 8_000
        assert got.groupBy("p").count().agg(F.max("count")).first()[0] <= 4_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_distinct_counts_by_bitmaps(spark):
    import random

    rng = random.Random(8)
    data = [(rng.choice([2019, 2020, 2021]), rng.choice([None, 0, -1, 5, 32768, 32769, 2**40, -(2**40), rng.randrange(100_000)]), rng.randrange(7), rng.choice(["a", "b", None])) for _ in range(3000)]
    df = spark.createDataFrame(data, "ano int, a bigint, b int, t string").repartition(4)
    yearly = stats.code_bitmaps(df, ["a", "b"], ["ano"])
    got = {(r.ano, r.coluna): r.distintos for r in stats.bitmap_counts(yearly, ["ano"]).collect()}
    for year in (2019, 2020, 2021):
        assert got[year, "a"] == len({r[1] for r in data if r[0] == year} - {None})
        assert got[year, "b"] == len({r[2] for r in data if r[0] == year})
    # Years merge without the rows.
    merged = {r.coluna: r.distintos for r in stats.bitmap_counts(yearly).collect()}
    assert merged == {"a": len({r[1] for r in data} - {None}), "b": 7}
    summary = stats.build_summary(df, {"x": "a", "y": "b", "z": "t"})
    assert summary.select("x", "y", "z").first() == (merged["a"], 7, 2)
    assert "Expand" not in summary._jdf.queryExecution().optimizedPlan().toString()
    assert stats.build_summary(df.where("false"), {"x": "a"}).first().x == 0
