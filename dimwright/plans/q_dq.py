"""Queries: data-quality metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimwright.operators import dq, scd, validate
from dimwright.operators.validate import STATUS_COL
from dimwright.plans import feeds
from dimwright.plans import oracle as O
from dimwright.plans.feeds import NATION, SEGMENT
from dimwright.plans.q_ingest import CLASSIFIED_SQL, FAULTED_SQL, classified, errors_long_sql
from dimwright.plans.feeds import ORDER_RULES
from dimwright.plans.q_scd import NATION_ROWS_SQL, _segment_rows_sql, account_replay, nation_rows, \
    run_col, segment_rows
from dimwright.plans.q_warehouse import FACT_SQL, fact
from dimwright.plans.registry import query
from dimwright.session import ensure_checkpoint_dir

LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _pct_sql(part: str, total: str) -> str:
    return (f"CASE WHEN {total} > 0 THEN CAST((2 * ({part}) * 10000 + ({total})) // (2 * ({total})) "
            f"AS DOUBLE) / 100.0 ELSE 0.0 END")


@query("dq_batch_counts", f"""SELECT source_batch_date AS batch, GROUPING(source_batch_date) = 1 AS is_total,
  count(*) FILTER (WHERE record_status = 'valid') AS valid_records,
  count(*) FILTER (WHERE record_status = 'invalid') AS invalid_records, count(*) AS total_records
FROM ({CLASSIFIED_SQL}) __c GROUP BY ROLLUP (source_batch_date)""")
def q_batch_counts(spark, sf):
    return dq.batch_counts(classified(spark, sf), "source_batch_date", STATUS_COL)


@query("dq_duplicate_rate", f"""WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
  GROUP BY l_orderkey, l_linenumber)
SELECT CAST(sum(n) AS BIGINT) AS total_records, count(*) AS distinct_keys,
  CAST(sum(n) - count(*) AS BIGINT) AS duplicate_count,
  {_pct_sql('sum(n) - count(*)', 'sum(n)')} AS duplicate_rate FROM k""")
def q_dup_rate(spark, sf):
    return dq.duplicate_rate(feeds.table(spark, sf, "lineitem"), LINE_KEYS)


@query("dq_duplicate_rate_by_batch", f"""WITH l AS (SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS b,
  l_orderkey, l_linenumber FROM lineitem),
p AS (SELECT b, count(*) AS total_records, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys
  FROM l GROUP BY b),
t AS (SELECT CAST(NULL AS DATE) AS b, count(*) AS total_records,
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM l) __d) AS distinct_keys FROM l),
u AS (SELECT * FROM p UNION ALL SELECT * FROM t)
SELECT b AS batch, b IS NULL AS is_total, total_records, distinct_keys,
  {_pct_sql('total_records - distinct_keys', 'total_records')} AS duplicate_rate FROM u""")
def q_dup_rate_batch(spark, sf):
    li = feeds.table(spark, sf, "lineitem").select(
        feeds.batch_of(F.col("l_shipdate")).alias("b"), *LINE_KEYS)
    return dq.duplicate_rate_by_batch(li, LINE_KEYS, "b")


@query("dq_error_breakdown", f"""SELECT field, code, count(*) AS error_count
FROM ({errors_long_sql(FAULTED_SQL, "o_orderkey", ORDER_RULES)}) __e GROUP BY field, code""")
def q_breakdown(spark, sf):
    return dq.breakdown_from_violations(
        validate.violations(feeds.faulted_orders(spark, sf), ORDER_RULES, []))


INPUTS_SQL = (f"SELECT source_batch_date, count(*) AS input_record_count FROM ({O.account_feed_sql()}) __i "
              f"GROUP BY source_batch_date")


@query("dq_reconciliation", f"""WITH i AS ({INPUTS_SQL}),
o AS (SELECT source_batch_date, count(*) FILTER (WHERE record_status = 'valid') AS valid_records,
  count(*) FILTER (WHERE record_status = 'invalid') AS invalid_records FROM ({CLASSIFIED_SQL}) __c
  GROUP BY source_batch_date),
p AS (SELECT COALESCE(i.source_batch_date, o.source_batch_date) AS batch, FALSE AS is_total,
  CAST(COALESCE(i.input_record_count, 0) AS BIGINT) AS input_records,
  CAST(COALESCE(o.valid_records, 0) AS BIGINT) AS valid_records,
  CAST(COALESCE(o.invalid_records, 0) AS BIGINT) AS invalid_records
  FROM i FULL OUTER JOIN o ON i.source_batch_date = o.source_batch_date),
u AS (SELECT * FROM p UNION ALL SELECT CAST(NULL AS DATE), TRUE, CAST(sum(input_records) AS BIGINT),
  CAST(sum(valid_records) AS BIGINT), CAST(sum(invalid_records) AS BIGINT) FROM p)
SELECT *, valid_records + invalid_records AS output_total,
  input_records - (valid_records + invalid_records) AS difference FROM u""")
def q_reconciliation(spark, sf):
    inputs = feeds.account_feed(spark, sf).groupBy("source_batch_date").agg(
        F.count(F.lit(1)).alias("input_record_count"))
    return dq.reconciliation(inputs, classified(spark, sf), "source_batch_date")


DIM_COUNTS_SQL = f"""SELECT 'dim_account' AS dimension_name, count(*) AS total_rows,
  count(*) FILTER (WHERE is_current) AS current_rows, count(*) FILTER (WHERE NOT is_current) AS historical_rows
FROM ({O.ACCOUNT_REPLAY}) __a
UNION ALL SELECT 'dim_nation', count(*), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
FROM ({O.replay_sql(NATION_ROWS_SQL, NATION)}) __n
UNION ALL SELECT 'dim_segment', count(*), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
FROM ({O.replay_sql(_segment_rows_sql(), SEGMENT)}) __s"""


def _dims(spark, sf):
    return {"dim_account": account_replay(spark, sf),
            "dim_nation": scd.replay(nation_rows(spark, sf), NATION, run_col()),
            "dim_segment": scd.replay(segment_rows(spark, sf), SEGMENT, run_col())}


@query("dq_dimension_counts", DIM_COUNTS_SQL)
def q_dim_counts(spark, sf):
    return dq.dimension_counts(_dims(spark, sf))


@query("dq_fact_rows", f"SELECT count(*) AS fact_rows FROM ({FACT_SQL}) __f")
def q_fact_rows(spark, sf):
    return fact(spark, sf).agg(F.count(F.lit(1)).alias("fact_rows"))


RUN_ROW_SQL = f"""WITH c AS ({CLASSIFIED_SQL}), i AS ({INPUTS_SQL}), d AS ({DIM_COUNTS_SQL}),
v AS (SELECT count(*) FILTER (WHERE record_status = 'valid') AS vn,
             count(*) FILTER (WHERE record_status = 'invalid') AS ivn FROM c),
vd AS (SELECT count(*) AS n FROM (SELECT DISTINCT o_custkey FROM c WHERE record_status = 'valid') __x),
ivd AS (SELECT count(*) AS n FROM (SELECT DISTINCT o_custkey FROM c WHERE record_status = 'invalid') __x),
pb AS (SELECT source_batch_date, count(*) FILTER (WHERE record_status = 'valid') AS vn,
  count(*) FILTER (WHERE record_status = 'invalid') AS ivn FROM c GROUP BY source_batch_date),
eb AS (SELECT field, code, count(*) AS n FROM ({errors_long_sql(FAULTED_SQL, "o_orderkey", ORDER_RULES)}) __e
  GROUP BY field, code)
SELECT 'dq-run' AS run_id,
  (SELECT CAST(sum(input_record_count) AS BIGINT) FROM i) AS input_records,
  v.vn AS valid_records, v.ivn AS invalid_records, v.vn + v.ivn AS total_records,
  {_pct_sql('v.vn', 'v.vn + v.ivn')} AS valid_rate,
  {_pct_sql('v.ivn', 'v.vn + v.ivn')} AS invalid_rate,
  (SELECT CAST(sum(input_record_count) AS BIGINT) FROM i) - (v.vn + v.ivn) AS reconciliation_difference,
  (SELECT count(*) FROM i) AS batch_count,
  (SELECT '{{' || string_agg('"' || CAST(source_batch_date AS VARCHAR) || '":' || CAST(vn AS VARCHAR), ','
     ORDER BY source_batch_date) || '}}' FROM pb) AS per_batch_valid,
  (SELECT '{{' || string_agg('"' || CAST(source_batch_date AS VARCHAR) || '":' || CAST(ivn AS VARCHAR), ','
     ORDER BY source_batch_date) || '}}' FROM pb) AS per_batch_invalid,
  {_pct_sql('v.vn - (SELECT n FROM vd)', 'v.vn')} AS valid_duplicate_rate,
  {_pct_sql('v.ivn - (SELECT n FROM ivd)', 'v.ivn')} AS invalid_duplicate_rate,
  (SELECT '{{' || string_agg('"' || field || '":' || inner_json, ',' ORDER BY field) || '}}'
     FROM (SELECT field, '{{' || string_agg('"' || code || '":' || CAST(n AS VARCHAR), ',' ORDER BY code) || '}}'
           AS inner_json FROM eb GROUP BY field) __f) AS error_breakdown,
  (SELECT total_rows FROM d WHERE dimension_name = 'dim_account') AS dim_account_total_rows,
  (SELECT current_rows FROM d WHERE dimension_name = 'dim_account') AS dim_account_current_rows,
  (SELECT historical_rows FROM d WHERE dimension_name = 'dim_account') AS dim_account_historical_rows,
  (SELECT total_rows FROM d WHERE dimension_name = 'dim_nation') AS dim_nation_total_rows,
  (SELECT total_rows FROM d WHERE dimension_name = 'dim_segment') AS dim_segment_total_rows,
  (SELECT count(*) FROM ({FACT_SQL}) __f) AS fact_rows
FROM v"""


@query("dq_run_row", RUN_ROW_SQL)
def q_run_row(spark, sf):
    """One metrics row per run.

    The classified feed is aggregated once, into a ledger of (batch, status, key)
    counts that all its figures come from.  Each source (ledger, inputs, error
    breakdown, dimensions, fact) becomes a one-row frame; ``dq.combine_rows`` puts them
    side by side and the rates are derived from the combined row.
    """
    from dimwright.functions.money import rounded_pct
    from dimwright.plans.q_warehouse import star

    ensure_checkpoint_dir(spark)
    status = F.col(STATUS_COL)
    entries = dq.ledger(classified(spark, sf), "source_batch_date", STATUS_COL, ["o_custkey"]).checkpoint(eager=True)
    per_batch = dq.ledger_counts(entries, "source_batch_date", STATUS_COL)
    counts = per_batch.agg(
        F.coalesce(F.sum("valid_records"), F.lit(0)).cast("long").alias("valid_records"),
        F.coalesce(F.sum("invalid_records"), F.lit(0)).cast("long").alias("invalid_records"),
        dq.per_batch_json("source_batch_date", "valid_records").alias("per_batch_valid"),
        dq.per_batch_json("source_batch_date", "invalid_records").alias("per_batch_invalid"))
    inputs = (feeds.account_feed(spark, sf).groupBy("source_batch_date").agg(F.count(F.lit(1)).alias("n"))
              .agg(F.sum("n").cast("long").alias("input_records"), F.count(F.lit(1)).alias("batch_count")))
    # duplicate rates of both sets over all batches
    keyed = entries.groupBy(STATUS_COL, "o_custkey").agg(F.sum("n").alias("n"))
    dups = keyed.agg(*[
        rounded_pct(F.sum(F.when(status == st, F.col("n"))) - F.count_if(status == st),
                    F.sum(F.when(status == st, F.col("n")))).alias(f"{st}_duplicate_rate")
        for st in ("valid", "invalid")])
    eb = dq.breakdown_json(dq.breakdown_from_violations(
        validate.violations(feeds.faulted_orders(spark, sf), ORDER_RULES, [])))
    st_ = star(spark, sf)
    acc = st_["dim_account"].agg(F.count(F.lit(1)).alias("dim_account_total_rows"),
                                 F.count_if(F.col("is_current")).alias("dim_account_current_rows"),
                                 F.count_if(~F.col("is_current")).alias("dim_account_historical_rows"))
    nat = st_["dim_nation"].agg(F.count(F.lit(1)).alias("dim_nation_total_rows"))
    seg = st_["dim_segment"].agg(F.count(F.lit(1)).alias("dim_segment_total_rows"))
    fct = st_["fact"].agg(F.count(F.lit(1)).alias("fact_rows"))
    row = dq.combine_rows([counts, inputs, dups, eb, acc, nat, seg, fct])
    vn, ivn = F.col("valid_records"), F.col("invalid_records")
    return row.select(
        F.lit("dq-run").alias("run_id"), "input_records", "valid_records", "invalid_records",
        (vn + ivn).alias("total_records"),
        rounded_pct(vn, vn + ivn).alias("valid_rate"),
        rounded_pct(ivn, vn + ivn).alias("invalid_rate"),
        (F.col("input_records") - (vn + ivn)).alias("reconciliation_difference"),
        "batch_count", "per_batch_valid", "per_batch_invalid", "valid_duplicate_rate",
        "invalid_duplicate_rate", "error_breakdown", "dim_account_total_rows",
        "dim_account_current_rows", "dim_account_historical_rows", "dim_nation_total_rows",
        "dim_segment_total_rows", "fact_rows")


@query("dq_error_breakdown_by_batch", f"""SELECT source_batch_date AS batch, field, code, count(*) AS error_count
FROM ({errors_long_sql(FAULTED_SQL, "o_orderkey, source_batch_date", ORDER_RULES)}) __e
GROUP BY source_batch_date, field, code""")
def q_breakdown_batch(spark, sf):
    """Error breakdown per batch (the per-batch section of the metrics row)."""
    v = validate.violations(feeds.faulted_orders(spark, sf), ORDER_RULES, ["source_batch_date"])
    return v.groupBy(F.col("source_batch_date").alias("batch"), "field", "code").agg(
        F.count(F.lit(1)).alias("error_count"))


@query("dq_feed_duplicate_rate_by_batch", f"""WITH c AS ({CLASSIFIED_SQL}),
p AS (SELECT record_status, source_batch_date AS b, count(*) AS total_records,
  count(DISTINCT o_custkey) + max(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) AS distinct_keys
  FROM c GROUP BY record_status, source_batch_date),
t AS (SELECT record_status, CAST(NULL AS DATE) AS b, count(*) AS total_records,
  count(DISTINCT o_custkey) + max(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) AS distinct_keys
  FROM c GROUP BY record_status)
SELECT record_status, b AS batch, b IS NULL AS is_total, total_records, distinct_keys,
  {_pct_sql('total_records - distinct_keys', 'total_records')} AS duplicate_rate
FROM (SELECT * FROM p UNION ALL SELECT * FROM t) __u""")
def q_feed_dup_batch(spark, sf):
    """Duplicate rate of the valid and of the invalid set, per batch and over all batches.

    The uniqueness key is the customer; a customer seen in several batches is a
    duplicate in the all-batch row; a NULL key counts as one value.
    """
    entries = dq.ledger(classified(spark, sf), "source_batch_date", STATUS_COL, ["o_custkey"])
    return dq.ledger_duplicate_rates(entries, "source_batch_date", STATUS_COL, ["o_custkey"])
