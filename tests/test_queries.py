"""Every registered query against its SQL oracle (DuckDB) on the smallest
input, plus the driver contract of __spark_entry__.py."""

import os
import tempfile

import pytest

from bizlens.plans import load_all, oracle_queries, spark_queries
from tests.parity import compare, duck

QUERIES = spark_queries()
ORACLES = oracle_queries()


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(load_all()) >= 150


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, small_dir, name):
    problems, n, _, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], small_dir)
    assert not problems, problems


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns[:3] == ["user_id", "visit_id", "visit_start_time"]
    assert df.count() > 0
    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())


def test_register_views_supports_sql(spark, small_dir):
    from bizlens.plans import register_views
    names = register_views(spark, small_dir, queries=False)
    assert "order_member_status" not in names and "sales" in names
    n = spark.sql("SELECT COUNT(*) FROM sales s JOIN menu m ON s.product_id = m.product_id").first()[0]
    assert n == spark.read.parquet(f"{small_dir}/lineitem.parquet").count()
    register_views(spark, small_dir)
    assert spark.sql("SELECT COUNT(*) FROM order_member_status").first()[0] == n


def test_building_queries_starts_no_job(spark, small_dir):
    """A query is a plan until its result is asked for; stored tables are on request."""
    tracker, group = spark.sparkContext.statusTracker(), "build-only"
    spark.sparkContext.setJobGroup(group, "building")
    try:
        for fn in QUERIES.values():
            fn(spark, small_dir)
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_store_is_a_snapshot_that_can_be_dropped(spark, small_dir):
    from bizlens.plans import STORED_TABLES, store_tables
    want = sorted(map(tuple, QUERIES["visit_summary_intended"](spark, small_dir).collect()), key=str)
    with store_tables(spark, small_dir, ("click_events", "users")) as store:
        stored = spark_queries(store)["visit_summary_intended"](spark, small_dir)
        assert sorted(map(tuple, stored.collect()), key=str) == want
        assert store.path in str(stored._jdf.queryExecution().optimizedPlan().toString()) or store.names == {"click_events", "users"}
        path = store.path
    assert not store.names and not os.path.exists(path.removeprefix("file:"))
    assert set(STORED_TABLES) >= {"sales", "users"}


def test_changed_input_is_seen(spark, small_dir):
    folder = tempfile.mkdtemp(prefix="bizlens-in-")
    src = spark.read.parquet(f"{small_dir}/orders.parquet")
    src.limit(10).write.parquet(f"{folder}/orders.parquet")
    q = QUERIES["totals_by_txn_type"]
    count = lambda: sum(r.unique_count for r in q(spark, folder).collect())
    assert count() == 10
    src.limit(5).write.mode("append").parquet(f"{folder}/orders.parquet")
    assert count() == 15


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from bizlens import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    Session.conf = type("Conf", (), {"get": lambda self, k, d=None: d})()
    with pytest.raises(RuntimeError, match="share"):
        session.ensure_checkpoint_dir(Session())
