"""Every registered query against its SQL counterpart, over whole tables."""

import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry, queries
from registry.oracle import ORACLE
from registry.spark_queries import QUERIES as REGISTERED

QUERIES = {name: query for name, query in queries().items() if name in REGISTERED}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return float(value) if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool) else value


def in_order(names, rows):
    """Columns by name, rows by value."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(REGISTERED) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    ours = in_order(df.columns, df.collect())
    found = duck.execute(ORACLE[name])
    theirs = in_order([d[0] for d in found.description], found.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]


def test_entry_runs(spark):
    df = entry(spark)
    assert df.limit(5).count() == 5
    assert {"target_id", "cand_id", "score", "target_rank"} <= set(df.columns)
