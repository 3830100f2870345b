import pytest

from __spark_entry__ import entry, oracle_sql, queries
from bench import HEADLINES
from check import connect, difference
from metricloom.workload import QUERIES
from tests.conftest import SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    assert difference(spark, duck, name, SMALL) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_plans_stay_on_the_jvm_and_have_no_cross_joins(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in FORBIDDEN if bad in plan]
    assert "Window" not in plan or "SinglePartition" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = queries()["report_a25_author_profile"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<turn:bigint,role:string,text:string>" in plan
    plan = queries()["report_a05_channels_per_year"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "c_name" not in plan and "c_acctbal" not in plan


def test_shares_scan_their_table_once(spark):
    plan = queries()["report_a15_language_shares"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "documents.parquet" not in plan  # what is left reads the grouped rows


def test_a_report_looks_for_its_own_network_only(spark):
    plan = queries()["report_a13_videos_per_instagram_mentions"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "t\\p{Punct}*+w" not in plan and "(?:i" in plan


@pytest.mark.parametrize("name", ["pct_change_country", "pct_change_playlists", "pct_change_videos"])
def test_snapshots_are_reduced_by_a_hash_table_first(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "Aggregate(" in line or "Exchange hash" in line or " Sort " in line]
    first = max(i for i, line in enumerate(lines) if "Exchange hash" in line)
    below = lines[first + 1 :]
    assert below and all("HashAggregate" in line and "ObjectHash" not in line for line in below)


def test_entry_points(spark):
    assert entry(spark).count() > 0
    assert QUERIES.keys() <= queries().keys() and QUERIES.keys() <= oracle_sql().keys()
    assert set(HEADLINES) <= queries().keys()
