"""Ranks and medians, also of large groups, against brute force."""

import random
import statistics

import pytest
from core_helpers import rows  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aferir.operators import lookup, order, stats


def skewed_rows(n=3000):
    rng = random.Random(7)
    data = []
    for i in range(n):
        group = rng.choice(["hot", "hot", "hot", "warm", None, f"g{i % 40}"])
        value = rng.choice([None, 0.0, 0.0, 0.0, float(rng.randrange(50)), rng.random() * 100])
        data.append((group, value, rng.randrange(9), i))
    return data


def brute_ranks(data):
    expected, groups = {}, {}
    for g, v, t, i in data:
        groups.setdefault(g, []).append((v, t, i))
    for members in groups.values():
        scored = sorted(m for m in members if m[0] is not None)
        expected.update({m[2]: r for r, m in enumerate(scored, 1)})
        expected.update({m[2]: None for m in members if m[0] is None})
    return expected


RANKS = [order.ordinal_rank, order.ordinal_rank_by_range]


@pytest.mark.parametrize("rank", RANKS)
def test_ordinal_rank(spark, rank):
    data = skewed_rows()
    df = spark.createDataFrame(data, "g string, v double, t int, i int").repartition(6)
    assert {r.i: r.r for r in rank(df, ["g"], ["v", "t", "i"], "r").collect()} == brute_ranks(data)


@pytest.mark.parametrize("rank", RANKS)
def test_text_ties(spark, rank):
    """Tie-breaks of any orderable type, also in one group that holds all rows."""
    df = spark.range(20_000).selectExpr("1 AS g", "5.0D AS v", "id AS i", "lpad(string(id), 6, '0') AS t").repartition(5)
    ranked = rank(df, ["g"], ["v", "t"], "r")
    assert ranked.where("r <> i + 1").isEmpty() and ranked.count() == 20_000


def test_plans_start_no_job(spark):
    """Statistics, percentiles, lookups and the cascade are plans until an action runs them."""
    sc = spark.sparkContext
    df = spark.createDataFrame(skewed_rows(50), "g string, v double, t int, i int")
    sc.setJobGroup("lazy", "plans only")
    try:
        scored = stats.score_stats(df, ["g", "t"], F.col("t") < 6, ["v"], meta=["i"], order=["i"])
        stats.group_percentile(scored, ["t"], "v_media", ["g"])
        lookup.lookup_join(df, df, ["g"], ["v"])
        codes = df.selectExpr("t AS ano", "i AS co_ies", "t AS co_area", "i AS co_municipio", "bigint(i) AS co_curso")
        lookup.enrich_codes(codes, codes, codes)
        assert sc.statusTracker().getJobIdsForGroup("lazy") == []
    finally:
        sc.setJobGroup("other", "")


def test_score_stats(spark):
    data = skewed_rows()
    df = spark.createDataFrame(data, "g string, v double, t int, i int").repartition(5)
    got = stats.score_stats(df, ["g"], F.col("t") < 6, ["v"], meta=["t"], order=["i"])
    groups = {}
    for g, v, t, i in data:
        groups.setdefault(g, []).append((i, v, t))
    assert got.count() == len(groups)
    for r in got.collect():
        members = groups[r.g]
        present = [v for _, v, t in members if t < 6 and v is not None]
        assert r.qt_inscritos == len(members)
        assert r.qt_presentes == sum(t < 6 for _, _, t in members)
        assert r.t == min(members)[2]
        assert r.v_mediana == (pytest.approx(statistics.median(present)) if present else None)
        assert r.v_media == (pytest.approx(statistics.fmean(present)) if present else None)
        assert r.v_dp == (pytest.approx(statistics.stdev(present)) if len(present) > 1 else None)


def test_group_without_present_rows(spark):
    df = spark.createDataFrame([(1, 222, 5.0), (1, 222, None), (2, 555, 4.0), (2, None, 9.0)], "k int, p int, v double")
    got = {r.k: r for r in stats.score_stats(df, ["k"], F.col("p") == 555, ["v"]).collect()}
    assert (got[1].qt_inscritos, got[1].qt_presentes, got[1].v_media, got[1].v_mediana) == (2, 0, None, None)
    assert (got[2].qt_presentes, got[2].v_mediana, got[2].v_dp) == (1, 4.0, None)


@pytest.mark.parametrize("by_range", [False, True])
def test_percentiles(spark, by_range):
    data = [("a", 10.0, 1), ("a", 10.0, 2), ("a", 30.0, 3), ("a", None, 4), ("b", 7.0, 5), ("c", None, 6),
            (None, 1.0, 7), (None, 2.0, 8)]
    df = spark.createDataFrame(data, "g string, v double, i int")
    got = stats.group_percentile(df, ["g"], "v", ["i"], by_range=by_range)
    assert {r.i: r.percentil_grupo for r in got.collect()} == {
        1: 0.0, 2: 50.0, 3: 100.0, 4: None, 5: 50.0, 6: 50.0, 7: 0.0, 8: 100.0
    }


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.floats(-50, 50).map(lambda x: round(x, 1))), min_size=1, max_size=60))
def test_median_of_any_rows(spark, data):
    df = spark.createDataFrame(data, "k int, v double")
    got = {r.k: r.v_mediana for r in order.exact_medians(df, ["k"], ["v"]).collect()}
    groups = {}
    for k, v in data:
        groups.setdefault(k, []).append(v)
    assert got == {k: pytest.approx(statistics.median(vs)) for k, vs in groups.items()}


@pytest.mark.parametrize("columns", [["v"], ["v", "t"]])
def test_medians_by_range(spark, columns):
    data = skewed_rows()
    df = spark.createDataFrame(data, "g string, v double, t int, i int").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.g: r.asDict() for r in order.exact_medians_by_range(df, ["g"], columns).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for at, name in ((1, "v"), (2, "t")):
        if name not in columns:
            continue
        groups = {}
        for row in data:
            if row[at] is not None:
                groups.setdefault(row[0], []).append(row[at])
        assert {g: r[f"{name}_mediana"] for g, r in got.items() if r[f"{name}_mediana"] is not None} == {
            g: pytest.approx(statistics.median(values)) for g, values in groups.items()
        }


def test_no_window_holds_a_whole_group(spark):
    import re

    df = spark.createDataFrame(skewed_rows(50), "g string, v double, t int, i int")
    plan = order.exact_medians_by_range(df, ["g"], ["v"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_part" in re.findall(r"\], \[(.*?)\], \[", line)[0] for line in windows)


def test_cascade_shuffles_the_base_once(spark, tmp_path):
    """All levels in one join: the base is exchanged once, the lookups on their own."""
    rng = random.Random(3)
    base = [(rng.randrange(3), rng.randrange(4), rng.choice([1, 2, 3, None]), None if rng.random() < 0.8 else 7) for _ in range(400)]
    micro = [(rng.randrange(3), rng.randrange(4), rng.choice([1, 2, 3, None]), rng.choice([10, 11, None])) for _ in range(14)]
    direct = [(rng.randrange(3), rng.randrange(4), rng.choice([1, 2, None]), rng.choice([20, 21, None])) for _ in range(9)]
    schema = "a int, b int, p int, c bigint"
    frames = [spark.createDataFrame(rows, schema) for rows in (base, micro, direct)]

    def codes(rows, key):
        found = {}
        for row in rows:
            if row[3] is not None:
                found.setdefault(key(row), set()).add(row[3])
        return {k: next(iter(v)) for k, v in found.items() if len(v) == 1 and None not in k}

    whole = [r for r in micro if None not in r]
    for placed in (True, False):
        by_key, by_place = codes(whole, lambda r: r[:2]), codes(whole, lambda r: r[:3])
        straight = codes(direct, lambda r: r[:3] if placed else r[:2])
        other = frames[2] if placed else frames[2].drop("p")
        got = lookup.enrich_codes(frames[0], frames[1], other, ["a", "b"], "p", "c")
        expected = [
            (a, b, p, c or straight.get((a, b, p) if placed else (a, b)) or by_key.get((a, b)) or by_place.get((a, b, p)))
            for a, b, p, c in base
        ]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
        dealt = lookup.enrich_codes(frames[0], frames[1], other, ["a", "b"], "p", "c", salts=4)
        assert sorted(map(tuple, dealt.collect()), key=repr) == sorted(expected, key=repr)
    frames[0].write.parquet(str(tmp_path / "base"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lookup.enrich_codes(spark.read.parquet(str(tmp_path / "base")), frames[1], frames[2], ["a", "b"], "p", "c")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1
    base_side = plan[: plan.index("FileScan")].splitlines()
    assert plan.count("FileScan") == 1 and sum("Exchange" in line for line in base_side) == 1
