"""Every registered query against the same result in SQL, whole tables, exact values."""

import datetime
import math
import os

import duckdb
import pytest

from aferir.oracles import ORACLES
from aferir.queries import QUERIES

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def normalised(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in records], key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sql, name):
    result = QUERIES[name](spark, FOLDER)
    cursor = sql.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(names)
    ours = normalised(result.columns, [tuple(r) for r in result.collect()])
    theirs = normalised(names, cursor.fetchall())
    assert len(ours) == len(theirs)
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not different, different[:5]
