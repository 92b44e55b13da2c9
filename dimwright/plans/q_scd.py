"""Queries: dedup, SCD (initial, incremental, type-1, insert-only, replay)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.contract import DedupSpec
from dimwright.operators import scd
from dimwright.operators.dedup import dedup_latest
from dimwright.operators.plan_utils import spread
from dimwright.plans import feeds
from dimwright.plans import oracle as O
from dimwright.plans.feeds import ACCOUNT, ACCOUNT_NULLABLE, NATION, SEGMENT
from dimwright.plans.registry import query
from dimwright.session import ensure_checkpoint_dir


def batch_rows(spark: SparkSession, sf: str, years: list[int] | None = None,
               spec=ACCOUNT) -> DataFrame:
    """Prepared rows of feed F for the given batch years (pushdown on o_orderdate)."""
    rows = feeds.account_rows(spark, sf, spec)
    if years is not None:
        rows = rows.where(F.year("source_batch_date").isin(years))
    return scd.prepare(rows, _no_dedup(spec))


def _no_dedup(spec):
    """The rows are already one per (key, batch)."""
    return spec.with_(dedup=DedupSpec(enabled=False))


def run_col():
    return feeds.scd_run_of(F.col("source_batch_date"))


def account_replay(spark: SparkSession, sf: str) -> DataFrame:
    return scd.replay(batch_rows(spark, sf), ACCOUNT, run_col())


@query("dedup_latest", O.ACCOUNT_ROWS_ALL)
def q_dedup_latest(spark, sf):
    return feeds.account_rows(spark, sf)


@query("dedup_latest_hot_key", O.dedup_sql(O.account_feed_sql(), "c_mktsegment, source_batch_date"))
def q_dedup_hot(spark, sf):
    """Dedup on a 5-value key: every group is hot (map-side combine keeps it cheap)."""
    return dedup_latest(feeds.account_feed(spark, sf), ["c_mktsegment", "source_batch_date"],
                        [("o_orderdate", True), ("o_orderkey", True)])


YEARS = list(range(1995, 2002))  # the batches of feed F


@query("scd_initial", O.initial_sql(O.enrich_sql(O.dedup_sql(O.RAW_ORDERS, "o_custkey")), ACCOUNT, "'scd-all'"))
def q_scd_initial(spark, sf):
    """The whole feed as one first load: the latest row per customer over all batches."""
    latest = dedup_latest(feeds.raw_orders(spark, sf), ["o_custkey"], ACCOUNT.dedup.order)
    return scd.initial_load(scd.prepare(feeds.enrich(latest, spark, sf), _no_dedup(ACCOUNT)), ACCOUNT, "scd-all")


@query("scd2_changed_keys", f"""
WITH s AS ({O.replay_sql(O.account_rows_sql(O.year_filter(1995, 2000)), ACCOUNT)}),
b AS ({O.account_rows_sql(O.year_filter(2001, 2001))})
SELECT DISTINCT b.o_custkey FROM b JOIN s ON b.o_custkey = s.o_custkey
WHERE s.is_current AND b.o_orderstatus IS NOT NULL AND b.o_orderstatus IS DISTINCT FROM s.o_orderstatus""")
def q_changed_keys(spark, sf):
    """Customers whose version the last batch changes, against the state after all batches before it."""
    state = scd.replay(batch_rows(spark, sf, YEARS[:-1]), ACCOUNT, run_col())
    return scd.changed_keys(state, batch_rows(spark, sf, YEARS[-1:]), ACCOUNT)


@query("scd2_incremental", O.ACCOUNT_REPLAY)
def q_scd2_incremental(spark, sf):
    """Every batch, 1995 to 2001, applied one at a time with the join step.

    Each step's state is materialised (reliable checkpoint), as each run of the
    job publishes a snapshot that the next run reads.
    """
    ensure_checkpoint_dir(spark)
    state = None
    for y in YEARS:
        state = scd.apply_batch(state, batch_rows(spark, sf, [y]), ACCOUNT, f"scd-{y}")
        if y != YEARS[-1]:
            state = state.checkpoint(eager=True)
    return state


@query("scd2_apply_pending", O.ACCOUNT_REPLAY)
def q_scd2_apply_pending(spark, sf):
    """State after 1995-1997, then the four pending batches 1998-2001 in ONE fold.

    The state is materialised (reliable checkpoint), as the job's fold reads a published snapshot.
    """
    ensure_checkpoint_dir(spark)
    state = scd.replay(batch_rows(spark, sf, [1995, 1996, 1997]), ACCOUNT, run_col()).checkpoint(eager=True)
    pending = batch_rows(spark, sf, [1998, 1999, 2000, 2001])
    return scd.apply_batches(state, pending, ACCOUNT, run_col(), feeds.order_parts(spark, sf))


@query("scd2_full_replay", O.ACCOUNT_REPLAY)
def q_scd2_full_replay(spark, sf):
    return account_replay(spark, sf)


NULLABLE_ROWS_SQL = f"""SELECT * REPLACE (
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice)
FROM ({O.ACCOUNT_ROWS_ALL}) __n"""


def nullable_rows(spark, sf):
    k = F.col("o_orderkey")
    return batch_rows(spark, sf, spec=ACCOUNT).withColumns({
        "o_orderstatus": F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")),
        "o_orderpriority": F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")),
        "o_totalprice": F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("o_totalprice")),
    })


@query("scd2_fold_replay", O.fold_sql(NULLABLE_ROWS_SQL, ACCOUNT_NULLABLE))
def q_scd2_fold(spark, sf):
    """Tracked fields with NULLs: the fold compares with the open version, not the last row."""
    return scd.replay(nullable_rows(spark, sf), ACCOUNT_NULLABLE, run_col(), method="fold")


ACCOUNT_T1 = ACCOUNT.with_(name="dim_account_t1", scd2_fields=())


@query("scd1_refresh", O.replay_sql(O.ACCOUNT_ROWS_ALL, ACCOUNT_T1))
def q_scd1_refresh(spark, sf):
    """Type-1 only: the last batch refreshes priority and price in the state of all batches before it."""
    state = scd.replay(batch_rows(spark, sf, YEARS[:-1]), ACCOUNT_T1, run_col())
    return scd.apply_batch(state, batch_rows(spark, sf, YEARS[-1:]), ACCOUNT_T1, f"scd-{YEARS[-1]}")


@query("scd1_apply_pending", O.replay_sql(O.ACCOUNT_ROWS_ALL, ACCOUNT_T1))
def q_scd1_apply_pending(spark, sf):
    """Type-1: state after three batches (materialised), the four pending ones in one fold."""
    ensure_checkpoint_dir(spark)
    state = scd.replay(batch_rows(spark, sf, YEARS[:3]), ACCOUNT_T1, run_col()).checkpoint(eager=True)
    return scd.apply_batches(state, batch_rows(spark, sf, YEARS[3:]), ACCOUNT_T1, run_col(), feeds.order_parts(spark, sf))


def _segment_rows_sql() -> str:
    return O.dedup_sql(O.account_feed_sql(), "c_mktsegment, source_batch_date")


def segment_rows(spark, sf, account_rows=None):
    rows = account_rows if account_rows is not None else feeds.account_rows(spark, sf)
    return scd.prepare(feeds.rollup_rows(rows, "c_mktsegment"), _no_dedup(SEGMENT))


@query("scd_insert_only", O.replay_sql(_segment_rows_sql(), SEGMENT))
def q_insert_only(spark, sf):
    """Insert-only over all batches: first seen row per segment wins."""
    return scd.replay(segment_rows(spark, sf), SEGMENT, run_col())


@query("scd_insert_only_apply_pending", O.replay_sql(_segment_rows_sql(), SEGMENT))
def q_insert_only_apply_pending(spark, sf):
    """Insert-only: state after three batches, the four pending ones in one fold."""
    rows = segment_rows(spark, sf)
    early = F.year("source_batch_date").isin(YEARS[:3])
    return scd.apply_batches(scd.replay(rows.where(early), SEGMENT, run_col()), rows.where(~early), SEGMENT, run_col())


def nation_rows(spark, sf, account_rows=None):
    rows = account_rows if account_rows is not None else feeds.account_rows(spark, sf)
    return scd.prepare(feeds.rollup_rows(rows, "c_nationkey"), _no_dedup(NATION))


NATION_ROWS_SQL = O.dedup_sql(O.account_feed_sql(), "c_nationkey, source_batch_date")


@query("scd1_nation_replay", O.replay_sql(NATION_ROWS_SQL, NATION))
def q_nation(spark, sf):
    return scd.replay(nation_rows(spark, sf), NATION, run_col())


@query("view_current", f"SELECT * FROM ({O.ACCOUNT_REPLAY}) WHERE is_current")
def q_view_current(spark, sf):
    return scd.current_view(account_replay(spark, sf))


HOT_ROWS_SQL = O.enrich_sql(O.dedup_sql(f"""SELECT * REPLACE (
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(0 AS BIGINT) ELSE o_custkey END AS o_custkey) FROM ({O.RAW_ORDERS}) __h"""))


@query("scd2_replay_hot_key", O.replay_sql(HOT_ROWS_SQL, ACCOUNT))
def q_hot_key(spark, sf):
    """Skew: a third of all orders belong to one customer.

    The per-(customer, batch) dedup combines map-side, so the hot customer
    reaches the shuffle as at most one row per batch and task; the entity
    window then sees one row per batch for it.
    """
    raw = feeds.raw_orders(spark, sf).withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("o_custkey")))
    latest = dedup_latest(raw, ["o_custkey", "source_batch_date"], ACCOUNT.dedup.order)
    rows = feeds.enrich(spread(latest, feeds.order_parts(spark, sf), "o_custkey"), spark, sf)
    return scd.replay(scd.prepare(rows, _no_dedup(ACCOUNT)), ACCOUNT, run_col())
