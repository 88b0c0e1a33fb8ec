"""Every registered query equals its SQL, and runs in Spark alone."""

import subprocess
import sys
from pathlib import Path

import duckdb  # noqa: F401
import pytest
from conftest import plan_of

import __spark_entry__ as contract
import check_oracle
from workload.oracle import ORACLE_SQL
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    rows, problem = check_oracle.compare(spark, con, name, SF_DIR)
    assert problem is None and rows > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql_without_broadcast(spark, no_broadcast, con, name):
    _, problem = check_oracle.compare(spark, con, name, SF_DIR)
    assert problem is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "request_id", "id_act", "fecha_salida", "codigo_salida",
    ]


def reads(df, table):
    return plan_of(df).count(f"/{table}.parquet")


@pytest.mark.parametrize("name", ["exit_own", "exit_child_event", "exit_candidates", "events_with_court"])
def test_chained_lookups_read_each_source_at_most_twice(spark, no_broadcast, name):
    assert 1 <= reads(QUERIES[name](spark, SF_DIR), "lineitem") <= 2


@pytest.mark.parametrize("name", ["drop_matching", "keep_matching"])
def test_matching_reads_each_side_at_most_twice(spark, no_broadcast, name):
    plan = QUERIES[name](spark, SF_DIR)
    assert all(reads(plan, table) <= 2 for table in ("orders", "lineitem", "customer"))


def test_one_chamber_is_pruned(spark):
    result = QUERIES["last_exit_event_one_chamber"](spark, SF_DIR)
    assert "LeftSemi" in plan_of(result)
    result.collect()
    # The requested cases are broadcast once for three joins, the courts shuffled once for two.
    final = plan_of(result).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange [idexp#") == 2
    assert final.count("ReusedExchange [id_oficina#") == 1


def test_log_bounds_reach_the_only_scan(spark):
    plan = plan_of(QUERIES["log_seconds_selected"](spark, SF_DIR))
    assert plan.count("FileScan") == 1 and "DataFilters: [isnotnull" in plan
    assert plan.count("Exchange rangepartitioning") == 1
    assert QUERIES["log_seconds_selected"](spark, SF_DIR).columns == ["segundos"]


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_runs_have_both_outcomes_at_every_scale(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    before = {r[0] for r in QUERIES["has_previous_period"](spark, sf_dir).select("tiene_anterior").distinct().collect()}
    assert before == {True, False}
    pending = QUERIES["pending_periods"](spark, sf_dir)
    assert {r.camara for r in pending.select("camara").distinct().collect()} >= set(range(23, 28))


def test_entry_works_without_the_training_operators():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("docketflow.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as contract
from workload.queries import QUERIES
assert set(contract.queries()) == set(QUERIES) == set(contract.oracle_sql())
"""
    repo = Path(contract.__file__).parent
    subprocess.run([sys.executable, "-c", code], cwd=repo, check=True)
