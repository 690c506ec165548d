"""Every relational query against its independent SQL form on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from cairn.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows_of(frame: pd.DataFrame):
    def cell(v):
        if v is None or v is pd.NA or v is pd.NaT or v != v:
            return "~"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"{v:.6f}"
        return str(v)

    return sorted(tuple(cell(v) for v in r) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["op_C1_concept_join", "op_C11_semi_either", "op_C15_interval", "op_C19_asof_forward", "op_C21_pair_nearest", "op_K16_candidate_cohort"])
def test_no_nested_loop_over_rows(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    if name != "op_C1_concept_join":  # there, rules meet distinct codes in one
        assert "BroadcastNestedLoopJoin" not in plan
