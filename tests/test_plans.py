"""Physical plans and session settings that scale depends on."""

import pytest
from pyspark.sql import functions as F

from dimwright import session
from dimwright.operators.plan_utils import counted_broadcast, planned_size_bytes, sized_broadcast
from dimwright.sources import paths, sinks

from support import SF001


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_sides_are_broadcast_and_large_ones_not(spark, no_auto_broadcast):
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    customer = spark.read.parquet(f"{SF001}/customer.parquet")
    assert planned_size_bytes(nation) > 0
    on = F.col("c_nationkey") == F.col("n_nationkey")
    assert "BroadcastHashJoin" in plan_of(customer.join(sized_broadcast(nation), on))
    assert "BroadcastHashJoin" not in plan_of(customer.join(sized_broadcast(nation, 10), on))
    assert "BroadcastHashJoin" in plan_of(customer.join(counted_broadcast(nation.checkpoint()), on))
    assert "BroadcastHashJoin" not in plan_of(customer.join(counted_broadcast(nation, 3), on))


def test_session_leaves_the_cluster_settings(spark, monkeypatch):
    assert not hasattr(session, "scratch_path")
    assert session._one_machine("local[4]") and session._one_machine("local")
    assert not session._one_machine("local-cluster[2,1,1024]") and not session._one_machine("yarn")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session.build_session()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_unreachable_filesystem_raises(spark, tmpdir_path):
    assert not paths.path_exists(spark, f"{tmpdir_path}/nothing")
    with pytest.raises(Exception, match="(?i)scheme"):
        paths.path_exists(spark, "nosuchscheme://x/y")
    with pytest.raises(Exception, match="(?i)scheme"):
        sinks.read_snapshot(spark, "nosuchscheme://x/y")


def test_only_whole_batch_names_count(spark, tmpdir_path):
    import os
    for n in ("batch-2025-01-15", "batch-2025-01-16-old", "batch-2025-99-99", "x"):
        os.makedirs(f"{tmpdir_path}/{n}")
    assert paths.discover_batch_dates(spark, tmpdir_path) == ["2025-01-15"]


def test_old_snapshot_versions_go(spark, tmpdir_path):
    import os
    for i in range(7):
        sinks.write_snapshot(spark.range(i + 1), f"{tmpdir_path}/s")
    assert sinks.read_snapshot(spark, f"{tmpdir_path}/s").count() == 7
    assert len([n for n in os.listdir(f"{tmpdir_path}/s") if n.startswith("v-")]) == sinks.KEPT_VERSIONS
    assert not [n for n in os.listdir(f"{tmpdir_path}/s") if n.startswith("_CURRENT.")]


def test_negative_amounts_round_half_up(spark):
    from dimwright.functions.money import avg_amount
    row = spark.range(1).select(avg_amount(F.lit(-150), F.lit(100)).alias("a"), avg_amount(F.lit(150), F.lit(100)).alias("b"),
                                avg_amount(F.lit(-149), F.lit(100)).alias("c")).first()
    assert (row["a"], row["b"], row["c"]) == (-0.02, 0.02, -0.01)


def test_null_keys_are_merged_not_repeated(spark):
    from dimwright.operators.keys import merge_append_missing, merge_upsert
    target = spark.createDataFrame([(1, "a", 1), (2, None, 2)], "id long, k string, v int")
    staging = spark.createDataFrame([(None, 5), ("b", 6)], "k string, v int")
    got = sorted((tuple(r) for r in merge_upsert(target, staging, ["k"], "id").collect()), key=repr)
    assert got == [(1, "a", 1), (2, None, 5), (3, "b", 6)]
    assert merge_append_missing(target.select("k", "v"), staging, ["k"]).count() == 3


def _shuffles_above(node, path, seen=()):
    """Names of the exchanges between the root and every scan of ``path``, broadcasts left out."""
    name = node.nodeName()
    if name.startswith("BroadcastExchange"):
        return set()
    seen = (*seen, name) if "Exchange" in name else seen
    children = [node.children().apply(i) for i in range(node.children().size())]
    if not children:
        return set(seen) if path in node.verboseStringWithOperatorId() else set()
    return set().union(*(_shuffles_above(c, path, seen) for c in children))


def test_a_small_batch_shuffles_no_state(spark, tmpdir_path, no_auto_broadcast):
    """The state's rows meet the batch where they lie: no exchange above the state's scan."""
    from dimwright.operators import scd
    from dimwright.plans.feeds import ACCOUNT
    from dimwright.plans.q_scd import account_replay, batch_rows
    path = f"{tmpdir_path}/state"
    scd.replay(batch_rows(spark, SF001, [1995, 1996]), ACCOUNT, "r1").write.parquet(path)
    batch_rows(spark, SF001, [1997]).write.parquet(f"{tmpdir_path}/batch")
    state, batch = spark.read.parquet(path), spark.read.parquet(f"{tmpdir_path}/batch")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = scd.apply_batch(state, batch, ACCOUNT, "r2")
        plan = out._jdf.queryExecution().executedPlan()
        assert _shuffles_above(plan, path) == set()
        text = plan.toString()
        assert text.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in text
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    want = scd.replay(batch_rows(spark, SF001, [1995, 1996, 1997]), ACCOUNT, "x").drop("last_updated_run_id")
    got = out.drop("last_updated_run_id")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("name,rules", [("validate_invalid", 3), ("validate_valid", 3), ("dq_feed_duplicate_rate_by_batch", 3)])
def test_every_rule_is_evaluated_once(spark, name, rules):
    """No filter on the status repeats the rules below the projection that evaluates them."""
    from dimwright.plans.catalog import QUERIES
    df = QUERIES[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    per_branch = plan.count("RLIKE")
    assert per_branch == rules * max(1, plan.count("Generate inline")), plan
