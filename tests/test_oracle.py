"""Every registered query against its SQL, on the smallest tables, and the joins it plans."""

import pytest

from __spark_entry__ import entry
from newsloom.plans.catalog import ORACLES, QUERIES
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"))
    table = df.toArrow()
    sql = ORACLES.get(name)
    if sql is None:
        assert table.num_rows > 0
    else:
        assert not differences(table, con.sql(sql).to_arrow_table())


def test_entry_has_rows(spark):
    first, second = entry(spark), entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0


def test_all_but_the_iterative_queries_have_sql():
    assert set(QUERIES) - set(ORACLES) == {"fitted_topic_share"}


@pytest.mark.parametrize("partitions", ["1", "17"])
def test_results_do_not_depend_on_the_partitioning(spark, con, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for name in ("backfill_mixed_targets", "build_index", "dedupe_chain", "resolve_redirects", "scrape", "tfidf_weights"):
            table = QUERIES[name](spark, SF).toArrow()
            assert not differences(table, con.sql(ORACLES[name]).to_arrow_table()), name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
