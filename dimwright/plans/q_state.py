"""Queries: control state, pending work, late-arrival rebuild, contract change."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimwright.operators import scd, state
from dimwright.plans import feeds
from dimwright.plans import oracle as O
from dimwright.plans.feeds import ACCOUNT, NATION, SEGMENT
from dimwright.plans.q_scd import account_replay, batch_rows, run_col
from dimwright.plans.registry import query

DIMS = ("dim_account", "dim_nation", "dim_segment")


def scd_control(spark, sf):
    """Synthetic etl_scd_batches rows derived from the order dates.

    Batches through 2000 are applied for every dimension; dim_account's
    1999 and 2000 batches are not loaded into the warehouse yet.  Versions:
    1.0 through 1997, 2.0 after, 3.0 for dim_segment's 2000 batch.
    """
    b = feeds.raw_orders(spark, sf).select(F.col("source_batch_date").alias("batch_date")) \
        .where(F.year("batch_date") <= 2000).distinct()
    d = b.select("batch_date", F.explode(F.array(*[F.lit(x) for x in DIMS])).alias("dimension_name"))
    y = F.year("batch_date")
    return d.select(
        "batch_date", "dimension_name",
        F.when(y <= 1997, "1.0").when((F.col("dimension_name") == "dim_segment") & (y == 2000), "3.0")
        .otherwise("2.0").alias("contract_version"),
        F.concat(F.lit("scd-"), F.date_format("batch_date", "yyyy")).alias("run_id"),
        F.date_add("batch_date", 1).alias("first_processed_on"),
        F.date_add("batch_date", 1).alias("processed_on"),
        F.when((y <= 1998) | (F.col("dimension_name") != "dim_account"), F.date_add("batch_date", 2))
        .alias("warehouse_loaded_on"))


CONTROL_SQL = f"""SELECT batch_date, dimension_name,
  CASE WHEN year(batch_date) <= 1997 THEN '1.0'
       WHEN dimension_name = 'dim_segment' AND year(batch_date) = 2000 THEN '3.0' ELSE '2.0' END
    AS contract_version,
  'scd-' || strftime(batch_date, '%Y') AS run_id,
  CAST(batch_date + INTERVAL 1 DAY AS DATE) AS first_processed_on,
  CAST(batch_date + INTERVAL 1 DAY AS DATE) AS processed_on,
  CASE WHEN year(batch_date) <= 1998 OR dimension_name <> 'dim_account'
       THEN CAST(batch_date + INTERVAL 2 DAY AS DATE) END AS warehouse_loaded_on
FROM (SELECT DISTINCT source_batch_date AS batch_date FROM ({O.RAW_ORDERS}) __o
      WHERE year(source_batch_date) <= 2000) __d,
     (VALUES ('dim_account'), ('dim_nation'), ('dim_segment')) __v(dimension_name)"""


@query("state_pending_star", f"""SELECT DISTINCT batch_date FROM ({CONTROL_SQL}) __c
WHERE dimension_name = 'dim_account' AND warehouse_loaded_on IS NULL ORDER BY batch_date""")
def q_pending_star(spark, sf):
    return state.pending_star(scd_control(spark, sf), "dim_account")


@query("pending_run_rows", f"""SELECT * FROM ({O.ACCOUNT_REPLAY}) __a WHERE last_updated_run_id IN (
  SELECT run_id FROM ({CONTROL_SQL}) __c WHERE dimension_name = 'dim_account' AND warehouse_loaded_on IS NULL)""")
def q_pending_run_rows(spark, sf):
    """Rows to load: touched by the runs that wrote the pending warehouse batches."""
    ctl = scd_control(spark, sf)
    runs = state.pending_run_ids(ctl, "dim_account", state.pending_star(ctl, "dim_account"))
    return state.rows_of_runs(account_replay(spark, sf), runs)


@query("state_latest_version", f"""SELECT dimension_name,
  arg_max(contract_version, (processed_on, batch_date)) AS latest_version
FROM ({CONTROL_SQL}) __c GROUP BY dimension_name""")
def q_latest_version(spark, sf):
    return state.latest_version(scd_control(spark, sf))


def _spec_versions(spark):
    return spark.createDataFrame([(d.name, d.contract_version) for d in (ACCOUNT, NATION, SEGMENT)],
                                 "dimension_name string, spec_version string")


@query("state_contract_change", f"""WITH l AS (SELECT dimension_name,
  arg_max(contract_version, (processed_on, batch_date)) AS latest_version FROM ({CONTROL_SQL}) __c
  GROUP BY dimension_name),
s AS (SELECT * FROM (VALUES ('dim_account', '{ACCOUNT.contract_version}'),
  ('dim_nation', '{NATION.contract_version}'), ('dim_segment', '{SEGMENT.contract_version}')) v(dimension_name, spec_version))
SELECT s.dimension_name, l.latest_version, s.spec_version,
  l.latest_version IS NOT NULL AND l.latest_version <> s.spec_version AS force_rebuild
FROM s LEFT JOIN l ON s.dimension_name = l.dimension_name""")
def q_contract_change(spark, sf):
    return state.contract_change(scd_control(spark, sf), _spec_versions(spark))


@query("state_mark_done", f"""WITH c AS ({CONTROL_SQL}),
s AS (SELECT DISTINCT source_batch_date AS batch_date, 'dim_account' AS dimension_name, '2.0' AS contract_version,
  'scd-2001' AS run_id, DATE '2002-01-15' AS first_processed_on, DATE '2002-01-15' AS processed_on,
  CAST(NULL AS DATE) AS warehouse_loaded_on
  FROM ({O.RAW_ORDERS}) __o WHERE year(source_batch_date) >= 2000)
SELECT COALESCE(c.batch_date, s.batch_date) AS batch_date,
  COALESCE(c.dimension_name, s.dimension_name) AS dimension_name,
  CASE WHEN s.batch_date IS NOT NULL THEN s.contract_version ELSE c.contract_version END AS contract_version,
  CASE WHEN s.batch_date IS NOT NULL THEN s.run_id ELSE c.run_id END AS run_id,
  COALESCE(c.first_processed_on, s.first_processed_on) AS first_processed_on,
  CASE WHEN s.batch_date IS NOT NULL THEN s.processed_on ELSE c.processed_on END AS processed_on,
  CASE WHEN s.batch_date IS NOT NULL THEN s.warehouse_loaded_on ELSE c.warehouse_loaded_on END
    AS warehouse_loaded_on
FROM c FULL OUTER JOIN s ON c.batch_date = s.batch_date AND c.dimension_name = s.dimension_name""")
def q_mark_done(spark, sf):
    """Re-run of 2000 and first run of 2001 for dim_account (first_processed_on kept)."""
    ctl = scd_control(spark, sf)
    batches = feeds.raw_orders(spark, sf).where(F.year("source_batch_date") >= 2000) \
        .select(F.col("source_batch_date").alias("batch_date")).distinct()
    return state.mark_scd_done(ctl, batches, "dim_account", "scd-2001", "2.0",
                               F.lit("2002-01-15").cast("date"))


@query("state_mark_loaded", f"""SELECT * REPLACE (CASE WHEN dimension_name = 'dim_account'
  AND year(batch_date) = 1999 THEN DATE '2002-02-01' ELSE warehouse_loaded_on END AS warehouse_loaded_on)
FROM ({CONTROL_SQL}) __c""")
def q_mark_loaded(spark, sf):
    ctl = scd_control(spark, sf)
    b = ctl.where(F.year("batch_date") == 1999).select("batch_date").distinct()
    return state.mark_loaded(ctl, b, "dim_account", F.lit("2002-02-01").cast("date"))


@query("state_clear_markers", f"""SELECT * REPLACE (CASE WHEN dimension_name = 'dim_nation' THEN NULL
  ELSE warehouse_loaded_on END AS warehouse_loaded_on) FROM ({CONTROL_SQL}) __c""")
def q_clear(spark, sf):
    return state.clear_markers(scd_control(spark, sf), "dim_nation")


LATE_YEAR = 1997


@query("late_batch_rebuild", O.ACCOUNT_REPLAY)
def q_late_rebuild(spark, sf):
    """1997 arrives after 1998-2000 were applied: the state is rebuilt from all batches."""
    applied_years = [1995, 1996, 1998, 1999, 2000]
    ctl = scd_control(spark, sf).where(
        (F.col("dimension_name") == "dim_account") & F.year("batch_date").isin(applied_years))
    available = feeds.raw_orders(spark, sf).select(F.col("source_batch_date").alias("batch_date")).distinct()
    pending = available.join(ctl.select("batch_date"), "batch_date", "left_anti")
    decision = state.late_arrival(ctl.select("batch_date"), pending).first()  # one control row
    if decision["is_late"]:
        return scd.replay(batch_rows(spark, sf), ACCOUNT, run_col())
    current = scd.replay(batch_rows(spark, sf, applied_years), ACCOUNT, run_col())
    pend_rows = batch_rows(spark, sf).join(pending.withColumnRenamed("batch_date", "source_batch_date"),
                                           "source_batch_date", "left_semi")
    return scd.apply_batches(current, pend_rows, ACCOUNT, run_col())


@query("check_missing_ingestion_state", f"""SELECT DISTINCT source_batch_date AS batch_date
FROM ({O.RAW_ORDERS}) __o WHERE year(source_batch_date) = 1999 ORDER BY batch_date""")
def q_missing_ingestion(spark, sf):
    """Valid batches without an ingestion marker (the 1999 marker was lost)."""
    valid = feeds.raw_orders(spark, sf).select(F.col("source_batch_date").alias("batch_date"))
    ingested = valid.where(F.year("batch_date") != 1999).distinct()
    return state.missing_ingestion_state(valid, ingested)


@query("check_load_coverage", f"""SELECT e.dimension_name, COALESCE(l.n, 0) AS loaded_batches
FROM (VALUES ('dim_account'), ('dim_nation'), ('dim_segment'), ('dim_date')) e(dimension_name)
LEFT JOIN (SELECT dimension_name, count(warehouse_loaded_on) AS n FROM ({CONTROL_SQL}) __c
  GROUP BY dimension_name) l ON e.dimension_name = l.dimension_name
WHERE COALESCE(l.n, 0) = 0""")
def q_load_coverage(spark, sf):
    from dimwright.operators import checks
    expected = spark.createDataFrame([(d,) for d in (*DIMS, "dim_date")], "dimension_name string")
    ctl = scd_control(spark, sf).withColumnRenamed("warehouse_loaded_on", "warehouse_loaded_at")
    return checks.load_coverage(ctl, expected)
