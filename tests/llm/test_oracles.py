import os

import duckdb
import pytest

from aferir.llm.oracles import ORACLES
from aferir.llm.queries import QUERIES

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "labels", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    result = QUERIES[name](spark, FOLDER)
    assert sorted(result.columns) == sorted(names)
    assert sorted(map(tuple, result.select(*names).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)
