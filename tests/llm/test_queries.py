"""The registered queries against their DuckDB SQL, and what holds for all of them."""

import pytest

import __spark_entry__ as entry
from joinery.llm.oracles import ORACLE_SQL
from joinery.llm.queries import QUERIES
from oracle import compare, duck

SF01 = "/root/testdata/sf0.01"
#: Queries whose main path may use DataFrame and SQL functions only.
NATIVE = ("op4_pii", "op5_chat", "op9_licenses")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    res = compare(QUERIES[name](spark, SF01), duck(SF01), ORACLE_SQL[name])
    assert res["ok"], res


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
