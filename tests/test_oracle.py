"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from clearledger.workload.oracle import ORACLE
from clearledger.workload.queries import REGISTRY as QUERIES
from tests.compare import differences, oracle_connection


@pytest.fixture(scope="module")
def con(sf_dir):
    with oracle_connection(sf_dir) as connection:
        yield connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


@pytest.fixture
def no_broadcast(spark):
    """Joins as they run when neither side is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", ["account_silver", "holding_silver"])
def test_large_joins_give_the_same_rows(spark, sf_dir, con, no_broadcast, name):
    df = QUERIES[name](spark, sf_dir)
    assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
    assert differences(df, con, ORACLE[name]) == []


def test_no_query_leaves_the_jvm_or_pairs_all_rows(spark, sf_dir):
    for name in sorted(n for n in QUERIES if n != "write_roundtrip" and "stored" not in n):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in plan, (name, node)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
