import re

from core_helpers import rows

from aferir.operators import join
from aferir.queries import QUERIES


def test_repeated_lookup_is_never_broadcast(spark):
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    # Its size is known to the planner, and small.
    lookup = spark.range(1, 4, 2).selectExpr("cast(id AS int) AS k", "if(id = 1, 'x', 'y') AS w")
    got = join.join_unique(facts, lookup, ["k"])
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert [(r["k"], r["v"], r["w"]) for r in rows(got)] == [(1, "a", "x"), (1, "b", "x"), (2, "c", None), (None, "d", None)]


def test_course_rows_are_dealt_before_they_are_repeated(spark, tmp_path):
    spark.sql("SELECT DATE'2020-05-01' l_shipdate, 1 l_linenumber, 1L l_partkey, 2D l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT 1L p_partkey, 7 p_size").write.parquet(f"{tmp_path}/part.parquet")
    got = QUERIES["q55_student_rows"](spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastNestedLoopJoin[^\n]*\n[ :+|-]*(Project[^\n]*\n[ :+|-]*)*Exchange hashpartitioning\(co_curso", plan)
    assert got.count() == 1
