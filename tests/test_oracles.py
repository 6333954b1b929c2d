"""Every query that has SQL gives the same columns, types and rows as DuckDB does."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as contract

# DuckDB type names beside Spark's.
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
         "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_oracle(name, spark, duck, sf_dir):
    mine = contract.queries()[name](spark, sf_dir)
    relation = duck.sql(contract.oracle_sql()[name])
    want = {c: TYPES[str(t)] for c, t in zip(relation.columns, relation.types)}
    assert dict(mine.dtypes) == want
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("CartesianProduct", "BroadcastNestedLoopJoin"))
    if not name.startswith("op"):
        assert any(word in plan for word in ("Python", "InPandas", "InArrow")) == name.startswith("udf_")
    columns = sorted(want)
    got = Counter(tuple(row) for row in mine.select(*columns).collect())
    expected = Counter(relation.select(*[f'"{c}"' for c in columns]).fetchall())
    assert got == expected
    assert got or name == "g_hash_collisions"


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_runs(name, spark, sf_dir):
    assert contract.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["id", "name", "in_degree"] and rows.count() == 10
