"""What one task of the SCD queries holds: rows sorted once, inputs read once, parts that grow with the tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimwright.operators import checks, scd
from dimwright.operators.plan_utils import FEW_PARTS, parts_for, spread
from dimwright.plans import feeds
from dimwright.plans.catalog import QUERIES

from support import SF001
from test_scd import D1, D2, D3, SPEC, as_dicts, df, random_rows, run_of

WINDOW = SPEC.with_(tracked_never_null=True)


@pytest.fixture()
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(scd, "fits_broadcast", lambda *a, **k: False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def nodes(d, name):
    plan = d._jdf.queryExecution().sparkPlan().toString() if name == "Join" else d._jdf.queryExecution().executedPlan().toString()
    return sum(line.lstrip(" :+-*()0123456789").startswith(name) or (name == "Join" and "Join " in line) for line in plan.splitlines())


def stored_state(spark, spec, rows):
    return scd.replay(df(spark, rows), spec, run_of(F.col("batch"))).checkpoint()


def test_replay_sorts_its_rows_once(spark):
    out = scd.replay(df(spark, random_rows(1, null_rate=0.0)), WINDOW, run_of(F.col("batch")))
    assert nodes(out, "Sort ") == 1 and nodes(out, "SortAggregate") == 0


def test_pending_fold_reads_state_and_rows_without_joining_them(spark, no_broadcast):
    state = stored_state(spark, WINDOW, [("1", "r1", D1, "a", 1.0, "x", "n")])
    out = scd.apply_batches(state, df(spark, [("1", "r2", D2, "b", 1.0, "x", "n")]), WINDOW, run_of(F.col("batch")))
    assert nodes(out, "Join") == 0 and nodes(out, "Sort ") == 1


@pytest.mark.parametrize("spec", [SPEC, WINDOW], ids=["fold", "window"])
def test_entities_without_a_pending_row_stay_as_they_are(spark, no_broadcast, spec):
    """Also with rows that no fold would give: two current rows of a key, an open end of its own, a key that is NULL."""
    state = stored_state(spark, spec, [("1", "r1", D1, "a", 1.0, "x", "n"), ("2", "r1", D1, "a", 1.0, None, "n"), (None, "r1", D1, "a", 1.0, "x", "n")])
    odd = state.where("id = '2'").withColumns({"end_date": F.lit(dt.date(2050, 1, 1)), "last_updated_run_id": F.lit("by hand")})
    state = state.unionByName(odd).unionByName(odd).checkpoint()
    out = scd.apply_batches(state, df(spark, [("1", "r3", D3, "b", 1.0, "y", "n"), (None, "r3", D3, "b", 1.0, "y", "n")]),
                            spec, run_of(F.col("batch")), parts=3)
    same = [r for r in as_dicts(out) if r["id"] == "2" or (r["id"] is None and r["start_date"] == D1)]
    assert sorted(map(repr, same)) == sorted(repr(r) for r in as_dicts(state) if r["id"] != "1")
    assert [(r["t1"], r["is_current"]) for r in as_dicts(out) if r["id"] == "1"] == [("a", False), ("b", True)]
    assert out.count() == 7


def test_current_is_latest_reads_the_versions_once(spark):
    d = spark.createDataFrame([(1, D1, True), (1, D1, True), (1, D2, False), (2, D1, None), (2, D2, True), (None, D1, True), (None, D2, False), (3, None, True)],
                              "k int, start_date date, is_current boolean")
    out = checks.current_is_latest(d, "k")
    assert nodes(out, "Join") == 0
    assert [tuple(r) for r in out.collect()] == [(1, D1, D2), (1, D1, D2)]


def test_check_replays_the_feed_once(spark):
    plan = QUERIES["check_current_is_latest"](spark, SF001)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("/orders.parquet") == 1


def test_kept_mart_reads_no_table_after_its_stored_parts(spark):
    plan = QUERIES["mart_kept_amount_by_month_nation"](spark, SF001)._jdf.queryExecution().sparkPlan().toString()
    assert "parquet" not in plan


def test_parts_grow_with_the_table(spark):
    orders = feeds.table(spark, SF001, "orders")
    assert parts_for(orders) is None and spread(orders, None, "o_custkey") is orders
    assert parts_for(orders, 1000) > parts_for(orders, 2000) > FEW_PARTS
    assert spread(orders, 40, "o_custkey").rdd.getNumPartitions() == 40
