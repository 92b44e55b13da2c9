"""Queries: integrity checks over deterministically corrupted results (non-empty)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimwright.operators import checks, dq, scd, validate
from dimwright.operators.validate import STATUS_COL
from dimwright.plans import feeds
from dimwright.plans import oracle as O
from dimwright.plans.feeds import ACCOUNT, NATION, ORDER_RULES
from dimwright.plans.q_dq import INPUTS_SQL
from dimwright.plans.q_ingest import CLASSIFIED_SQL, FAULTED_SQL, classified, errors_long_sql
from dimwright.plans.q_scd import NATION_ROWS_SQL, account_replay, batch_rows, nation_rows, run_col
from dimwright.plans.q_warehouse import FACT_SQL, WH_ACCOUNT_SQL, fact, star, wh_account
from dimwright.plans.registry import query

K = "o_custkey"


def corrupted_account(spark, sf):
    d = account_replay(spark, sf)
    k = F.col(K)
    cur = F.col("is_current")
    d = d.withColumns({
        "is_current": F.when(k % 89 == 0, F.lit(True)).when(k % 83 == 0, F.lit(False)).otherwise(cur),
        "end_date": (F.when((k % 97 == 0) & ~cur, F.date_add("end_date", 3))
                     .when((k % 67 == 0) & cur, F.lit(None).cast("date"))
                     .when((k % 61 == 0) & cur, F.lit("2050-01-01").cast("date"))
                     .otherwise(F.col("end_date"))),
        "start_date": F.when(k % 71 == 0, F.date_add("start_date", 1)).otherwise(F.col("start_date")),
        "o_orderstatus": F.when(k % 59 == 0, F.lit("F")).otherwise(F.col("o_orderstatus")),
    })
    # some versions twice, made from the row itself: a union would replay the feed for each side
    copies = F.when(k % 73 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return d.select("*", F.explode(copies).alias("__copy")).drop("__copy")


CORRUPT_SQL = f"""WITH __r AS ({O.ACCOUNT_REPLAY}),
__c AS (SELECT * REPLACE (
  CASE WHEN o_custkey % 89 = 0 THEN TRUE WHEN o_custkey % 83 = 0 THEN FALSE ELSE is_current END AS is_current,
  CASE WHEN o_custkey % 97 = 0 AND NOT is_current THEN CAST(end_date + INTERVAL 3 DAY AS DATE)
       WHEN o_custkey % 67 = 0 AND is_current THEN NULL
       WHEN o_custkey % 61 = 0 AND is_current THEN DATE '2050-01-01' ELSE end_date END AS end_date,
  CASE WHEN o_custkey % 71 = 0 THEN CAST(start_date + INTERVAL 1 DAY AS DATE) ELSE start_date END AS start_date,
  CASE WHEN o_custkey % 59 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus) FROM __r)
SELECT * FROM __c UNION ALL SELECT * FROM __c WHERE o_custkey % 73 = 0"""


@query("check_one_current", f"""SELECT o_custkey, count(*) FILTER (WHERE is_current) AS current_count
FROM ({CORRUPT_SQL}) __d GROUP BY o_custkey HAVING count(*) FILTER (WHERE is_current) <> 1""")
def q_one_current(spark, sf):
    return checks.one_current(corrupted_account(spark, sf), K)


@query("check_current_is_latest", f"""WITH d AS ({CORRUPT_SQL}),
m AS (SELECT o_custkey, max(start_date) AS latest_start FROM d GROUP BY o_custkey)
SELECT d.o_custkey, d.start_date, m.latest_start FROM d JOIN m ON d.o_custkey = m.o_custkey
WHERE d.is_current AND d.start_date < m.latest_start""")
def q_current_latest(spark, sf):
    return checks.current_is_latest(corrupted_account(spark, sf), K)


@query("check_natural_key_dups", f"""SELECT o_custkey, start_date, count(*) AS row_count
FROM ({CORRUPT_SQL}) __d GROUP BY o_custkey, start_date HAVING count(*) > 1""")
def q_nk_dups(spark, sf):
    return checks.natural_key_dups(corrupted_account(spark, sf), [K, "start_date"])


@query("check_start_eq_batch", f"""SELECT o_custkey, start_date, source_batch_date FROM ({CORRUPT_SQL}) __d
WHERE start_date IS DISTINCT FROM source_batch_date""")
def q_start_eq_batch(spark, sf):
    return checks.start_eq_batch(corrupted_account(spark, sf), K)


@query("check_open_sentinel", f"""SELECT o_custkey, start_date, end_date, is_current FROM ({CORRUPT_SQL}) __d
WHERE end_date IS NULL OR (is_current AND end_date <> DATE '2099-12-31')""")
def q_open_sentinel(spark, sf):
    return checks.open_sentinel(corrupted_account(spark, sf), K)


@query("check_gapless_versions", f"""SELECT * FROM (SELECT o_custkey, start_date, end_date,
  LEAD(start_date) OVER (PARTITION BY o_custkey ORDER BY start_date) AS next_start FROM ({CORRUPT_SQL}) __d) __x
WHERE next_start IS NOT NULL AND end_date IS DISTINCT FROM CAST(next_start - INTERVAL 1 DAY AS DATE)""")
def q_gapless(spark, sf):
    return checks.gapless_versions(corrupted_account(spark, sf), K)


@query("check_versions_differ", f"""SELECT o_custkey, start_date FROM (SELECT o_custkey, start_date,
  LAG(start_date) OVER w IS NOT NULL AND o_orderstatus IS NOT DISTINCT FROM LAG(o_orderstatus) OVER w AS same
  FROM ({CORRUPT_SQL}) __d WINDOW w AS (PARTITION BY o_custkey ORDER BY start_date)) __x WHERE same""")
def q_versions_differ(spark, sf):
    return checks.versions_differ(corrupted_account(spark, sf), K, ACCOUNT.scd2_fields)


NATION_CORRUPT_SQL = f"""SELECT * REPLACE (CASE WHEN c_nationkey % 7 = 0 THEN DATE '2001-01-01'
  ELSE source_batch_date END AS source_batch_date) FROM ({O.replay_sql(NATION_ROWS_SQL, NATION)}) __n"""


@query("check_first_seen", f"""WITH s AS (SELECT c_nationkey, min(source_batch_date) AS stored_first
  FROM ({NATION_CORRUPT_SQL}) __a GROUP BY c_nationkey),
f AS (SELECT c_nationkey, min(source_batch_date) AS first_seen FROM ({O.account_feed_sql()}) __f GROUP BY c_nationkey)
SELECT s.c_nationkey, s.stored_first, f.first_seen FROM s JOIN f ON s.c_nationkey = f.c_nationkey
WHERE s.stored_first IS DISTINCT FROM f.first_seen""")
def q_first_seen(spark, sf):
    """Type-1 refresh must keep the first-introduced batch date."""
    nat = scd.replay(nation_rows(spark, sf), NATION, run_col())
    nat = nat.withColumn("source_batch_date", F.when(F.col("c_nationkey") % 7 == 0,
                                                     F.lit("2001-01-01").cast("date"))
                         .otherwise(F.col("source_batch_date")))
    return checks.first_seen(nat, feeds.account_feed(spark, sf), "c_nationkey")


@query("check_fact_first_seen", f"""WITH a AS ({WH_ACCOUNT_SQL}),
f AS (SELECT * REPLACE (CASE WHEN account_id % 13 = 0 THEN date_id + 1 ELSE date_id END AS date_id) FROM ({FACT_SQL}) __f),
single AS (SELECT o_custkey FROM a GROUP BY o_custkey HAVING count(*) = 1),
seen AS (SELECT o_custkey, min(source_batch_date) AS first_seen FROM ({O.account_feed_sql()}) __s GROUP BY o_custkey)
SELECT a.o_custkey, f.date_id, CAST(strftime(seen.first_seen, '%Y%m%d') AS INTEGER) AS expected_date_id
FROM f JOIN a ON f.account_id = a.account_id JOIN seen ON a.o_custkey = seen.o_custkey
WHERE a.o_custkey IN (SELECT o_custkey FROM single)
  AND f.date_id <> CAST(strftime(seen.first_seen, '%Y%m%d') AS INTEGER)""")
def q_fact_first_seen(spark, sf):
    st = star(spark, sf)
    f = st["fact"]
    f = f.withColumn("date_id", F.when(F.col("account_id") % 13 == 0, F.col("date_id") + 1)
                     .otherwise(F.col("date_id")))
    return checks.fact_first_seen(f, st["dim_account"], feeds.account_feed(spark, sf),
                                  key=K, dim_key="account_id")


@query("check_fk_orphans", f"""WITH a AS (SELECT * REPLACE (CASE WHEN o_custkey % 11 = 0 THEN c_nationkey + 100
  ELSE c_nationkey END AS c_nationkey) FROM ({O.ACCOUNT_REPLAY}) __a)
SELECT a.o_custkey, a.start_date, a.c_nationkey FROM a
WHERE a.c_nationkey NOT IN (SELECT c_nationkey FROM ({O.replay_sql(NATION_ROWS_SQL, NATION)}) __n)""")
def q_fk_orphans(spark, sf):
    """Base rows whose nation key has no dimension row (keys corrupted for some customers)."""
    nat = scd.replay(nation_rows(spark, sf), NATION, run_col())
    acc = account_replay(spark, sf).withColumn(
        "c_nationkey", F.when(F.col(K) % 11 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey")))
    return checks.fk_orphans(acc, nat, "c_nationkey", "c_nationkey", [K, "start_date"])


@query("check_domain", f"""SELECT o_orderkey, o_orderstatus FROM ({FAULTED_SQL}) __f
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O', 'P')""")
def q_domain(spark, sf):
    return checks.domain(feeds.faulted_orders(spark, sf), "o_orderstatus", ["F", "O", "P"], ["o_orderkey"])


NN_COLS = ["o_custkey", "c_name", "o_orderstatus", "o_orderpriority", "o_totalprice", "c_mktsegment"]


@query("check_not_null", " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count "
    f"FROM ({FAULTED_SQL}) __f) __x WHERE null_count > 0" for c in NN_COLS))
def q_not_null(spark, sf):
    return checks.not_null(feeds.faulted_orders(spark, sf), NN_COLS)


DECLARED = [fr.field for fr in ORDER_RULES]


@query("check_invalid_structure", f"""SELECT o_orderkey, 'bogus_field' AS unexpected_fields,
  CAST(count(DISTINCT field) + 1 AS INTEGER) AS error_fields
FROM ({errors_long_sql(FAULTED_SQL, "o_orderkey", ORDER_RULES)}) __e WHERE o_orderkey % 11 = 0
GROUP BY o_orderkey""")
def q_invalid_structure(spark, sf):
    _, invalid = validate.split_valid_invalid(feeds.faulted_orders(spark, sf), ORDER_RULES)
    invalid = invalid.withColumn("validation_errors", F.when(
        F.col("o_orderkey") % 11 == 0,
        F.map_concat("validation_errors", F.create_map(F.lit("bogus_field"), F.array(F.lit("x")))))
        .otherwise(F.col("validation_errors")))
    return checks.invalid_structure(invalid, DECLARED, "o_orderkey")


@query("check_valid_structure", f"""WITH v AS (SELECT * FROM ({CLASSIFIED_SQL}) __c WHERE record_status = 'valid')
SELECT o_orderkey, 'o_totalprice' AS field, 'minValue: 1000' AS code FROM v WHERE o_orderkey % 17 = 0
UNION ALL SELECT o_orderkey, 'processed_run_id', 'missing' FROM v WHERE o_orderkey % 19 = 0""")
def q_valid_structure(spark, sf):
    """A valid set in which some amounts and run ids were spoilt afterwards."""
    valid, _ = validate.split_valid_invalid(feeds.faulted_orders(spark, sf), ORDER_RULES)
    k = F.col("o_orderkey")
    valid = valid.withColumns({"o_totalprice": F.when(k % 17 == 0, F.lit(-1.0)).otherwise(F.col("o_totalprice")),
                               "processed_run_id": F.when(k % 19 != 0, F.col("processed_run_id"))})
    return checks.valid_structure(valid, ORDER_RULES, "o_orderkey", ["source_batch_date", "processed_run_id"])


@query("check_dq_consistent", f"""WITH i AS ({INPUTS_SQL}),
c AS (SELECT * FROM ({CLASSIFIED_SQL}) __c WHERE NOT (record_status = 'invalid'
  AND year(source_batch_date) = 1996 AND o_orderkey % 2 = 0)),
o AS (SELECT source_batch_date, count(*) AS n FROM c GROUP BY source_batch_date),
p AS (SELECT i.source_batch_date AS batch, i.input_record_count - COALESCE(o.n, 0) AS difference
  FROM i LEFT JOIN o ON i.source_batch_date = o.source_batch_date)
SELECT 'difference' AS issue, batch, difference AS delta FROM p WHERE difference <> 0
UNION ALL SELECT 'difference', NULL, CAST(sum(difference) AS BIGINT) FROM p HAVING sum(difference) <> 0""")
def q_dq_consistent(spark, sf):
    """Reconciliation over an output that lost rows of 1996's invalid set."""
    c = classified(spark, sf)
    c = c.where(~((F.col(STATUS_COL) == "invalid") & (F.year("source_batch_date") == 1996)
                  & (F.col("o_orderkey") % 2 == 0)))
    inputs = feeds.account_feed(spark, sf).groupBy("source_batch_date").agg(
        F.count(F.lit(1)).alias("input_record_count"))
    return checks.dq_consistent(dq.reconciliation(inputs, c, "source_batch_date"))


EQ_FIELDS = [c for c in ACCOUNT.columns() if c not in (K, "start_date")]


@query("check_snapshot_equivalence", f"""WITH s AS ({O.ACCOUNT_REPLAY}),
w AS (SELECT * REPLACE (
  CASE WHEN o_custkey % 43 = 0 THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_custkey % 41 = 0 THEN CAST(start_date + INTERVAL 1 DAY AS DATE) ELSE start_date END AS start_date)
  FROM ({WH_ACCOUNT_SQL}) __w)
SELECT COALESCE(s.o_custkey, w.o_custkey) AS o_custkey, COALESCE(s.start_date, w.start_date) AS start_date,
  CASE WHEN w.o_custkey IS NULL THEN 'missing_in_warehouse' WHEN s.o_custkey IS NULL THEN 'missing_in_snapshot'
       ELSE 'different' END AS issue
FROM s FULL OUTER JOIN w ON s.o_custkey = w.o_custkey AND s.start_date = w.start_date
WHERE w.o_custkey IS NULL OR s.o_custkey IS NULL OR
  ({' OR '.join(f's.{f} IS DISTINCT FROM w.{f}' for f in EQ_FIELDS)})""")
def q_snapshot_eq(spark, sf):
    w = wh_account(spark, sf).withColumns({
        "o_totalprice": F.when(F.col(K) % 43 == 0, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice")),
        "start_date": F.when(F.col(K) % 41 == 0, F.date_add("start_date", 1)).otherwise(F.col("start_date")),
    })
    return checks.snapshot_equivalence(account_replay(spark, sf), w, [K, "start_date"], EQ_FIELDS)


@query("check_fact_measure", f"""SELECT account_id, order_amount FROM (SELECT account_id,
  CASE WHEN account_id % 37 = 0 THEN NULL ELSE order_amount END AS order_amount FROM ({FACT_SQL}) __f) __x
WHERE order_amount IS NULL""")
def q_fact_measure(spark, sf):
    f = fact(spark, sf).withColumn("order_amount", F.when(F.col("account_id") % 37 == 0, F.lit(None))
                                   .otherwise(F.col("order_amount")))
    return checks.fact_measure(f, "account_id", ["order_amount"])


@query("check_fact_dates", f"""WITH f AS (SELECT DISTINCT CASE WHEN date_id >= 20010101 THEN 20010102 ELSE date_id END
  AS date_id FROM ({FACT_SQL}) __f),
d AS (SELECT DISTINCT CAST(strftime(source_batch_date, '%Y%m%d') AS INTEGER) AS date_id FROM ({O.ACCOUNT_REPLAY}) __a)
SELECT date_id, 'missing_in_fact' AS side FROM d WHERE date_id NOT IN (SELECT date_id FROM f)
UNION ALL SELECT date_id, 'missing_in_dimension' FROM f WHERE date_id NOT IN (SELECT date_id FROM d)""")
def q_fact_dates(spark, sf):
    f = fact(spark, sf).withColumn("date_id", F.when(F.col("date_id") >= 20010101, F.lit(20010102))
                                   .otherwise(F.col("date_id")))
    return checks.fact_dates(f, account_replay(spark, sf))


@query("check_input_parseable", """WITH e AS (SELECT event_id, CAST(ts AS DATE) AS day,
  CASE WHEN event_id % 50 = 0 THEN 'not json' WHEN event_id % 77 = 0 THEN '{"k": "zz"}'
       WHEN event_id % 91 = 0 THEN '' ELSE props END AS raw FROM events),
p AS (SELECT *, CASE WHEN json_valid(raw) THEN COALESCE(json_type(raw) = 'OBJECT'
  AND TRY_CAST(json_extract_string(raw, '$.k') AS INTEGER) IS NOT NULL, FALSE) ELSE FALSE END AS ok FROM e),
g AS (SELECT day, count(*) AS row_count, count(*) FILTER (WHERE NOT ok) AS unparseable_rows,
  arg_min(ok, event_id) AS first_line_ok FROM p GROUP BY day)
SELECT * FROM g WHERE row_count = 0 OR NOT first_line_ok""")
def q_input_parseable(spark, sf):
    """Per input day: the first line must parse (days starting with a bad line fail)."""
    e = feeds.table(spark, sf, "events")
    i = F.col("event_id")
    raw = (F.when(i % 50 == 0, F.lit("not json")).when(i % 77 == 0, F.lit('{"k": "zz"}'))
           .when(i % 91 == 0, F.lit("")).otherwise(F.col("props")))
    return checks.input_parseable(e.select("event_id", F.col("ts").cast("date").alias("day"), raw.alias("raw")),
                                  "day", "event_id", "raw", "k int")


@query("check_unchanged_single_version", f"""WITH d AS (SELECT * FROM ({O.ACCOUNT_REPLAY}) __a
  UNION ALL SELECT * FROM ({O.ACCOUNT_REPLAY}) __b WHERE o_custkey % 7 = 0),
f AS (SELECT o_custkey, count(DISTINCT source_batch_date) AS batches FROM ({O.ACCOUNT_ROWS_ALL}) __f
  GROUP BY o_custkey HAVING count(DISTINCT source_batch_date) > 1 AND count(DISTINCT o_orderstatus) = 1),
v AS (SELECT o_custkey, count(*) AS versions FROM d GROUP BY o_custkey HAVING count(*) > 1)
SELECT f.o_custkey, f.batches, v.versions FROM f JOIN v ON f.o_custkey = v.o_custkey""")
def q_unchanged(spark, sf):
    """A dimension that re-versioned stable entities (rows of key % 7 written twice)."""
    d = account_replay(spark, sf)
    d = d.unionByName(d.where(F.col(K) % 7 == 0))
    return checks.unchanged_single_version(d, batch_rows(spark, sf), K, ACCOUNT.scd2_fields)


def _pct(part: str, total: str) -> str:
    return f"CAST((2 * ({part}) * 10000 + ({total})) // (2 * ({total})) AS DOUBLE) / 100.0"


METRICS_SQL = f"""WITH b AS (SELECT source_batch_date AS d, count(*) FILTER (WHERE record_status = 'valid') AS vn,
  count(*) FILTER (WHERE record_status = 'invalid') AS ivn, count(*) AS n FROM ({CLASSIFIED_SQL}) __c GROUP BY source_batch_date),
m AS (SELECT 'run-' || strftime(d, '%Y') AS run_id, year(d) AS y, n + CASE WHEN year(d) = 1996 THEN 1 ELSE 0 END AS input_records,
  vn + CASE WHEN year(d) = 1997 THEN 5 ELSE 0 END AS valid_records, ivn AS invalid_records, n AS total_records,
  CASE WHEN year(d) = 1995 THEN 7 WHEN year(d) = 1996 THEN 1 ELSE 0 END AS reconciliation_difference,
  CASE WHEN year(d) = 1998 THEN 0.0 ELSE {_pct('vn', 'n')} END AS valid_rate, {_pct('ivn', 'n')} AS invalid_rate,
  CASE WHEN year(d) = 1999 THEN 2 ELSE 1 END AS batch_count, vn AS listed_valid,
  ivn + CASE WHEN year(d) = 2000 THEN 1 ELSE 0 END AS listed_invalid FROM b)"""


@query("check_dq_row_consistent", f"""{METRICS_SQL},
i AS (SELECT run_id, 'total' AS issue FROM m WHERE total_records <> valid_records + invalid_records
UNION ALL SELECT run_id, 'difference' FROM m WHERE reconciliation_difference <> input_records - total_records
UNION ALL SELECT run_id, 'lost_records' FROM m WHERE reconciliation_difference <> 0
UNION ALL SELECT run_id, 'per_batch_valid' FROM m WHERE listed_valid <> valid_records
UNION ALL SELECT run_id, 'per_batch_invalid' FROM m WHERE listed_invalid <> invalid_records
UNION ALL SELECT run_id, 'batch_count' FROM m WHERE batch_count <> 1
UNION ALL SELECT run_id, 'rates' FROM m WHERE total_records > 0 AND abs(valid_rate + invalid_rate - 100) > 0.011)
SELECT * FROM i""")
def q_dq_row_consistent(spark, sf):
    """Stored metrics rows, one run per batch, spoilt year by year: every contradiction is named."""
    from dimwright.functions.money import rounded_pct

    entries = dq.ledger(classified(spark, sf), "source_batch_date", STATUS_COL, [])
    y, vn, ivn = F.year("source_batch_date"), F.col("valid_records"), F.col("invalid_records")
    listed = lambda n: F.to_json(F.create_map(F.col("source_batch_date").cast("string"), n))
    rows = dq.ledger_counts(entries, "source_batch_date", STATUS_COL).select(
        F.concat(F.lit("run-"), F.date_format("source_batch_date", "yyyy")).alias("run_id"),
        (vn + ivn + (y == 1996).cast("int")).alias("input_records"), (vn + F.when(y == 1997, 5).otherwise(0)).alias("valid_records"),
        ivn.alias("invalid_records"), (vn + ivn).alias("total_records"),
        F.when(y == 1995, 7).when(y == 1996, 1).otherwise(0).alias("reconciliation_difference"),
        F.when(y == 1998, 0.0).otherwise(rounded_pct(vn, vn + ivn)).alias("valid_rate"), rounded_pct(ivn, vn + ivn).alias("invalid_rate"),
        F.when(y == 1999, 2).otherwise(1).alias("batch_count"), listed(vn).alias("per_batch_valid"),
        listed(ivn + (y == 2000).cast("int")).alias("per_batch_invalid"))
    return checks.dq_row_consistent(rows)


@query("check_input_present", """WITH e AS (SELECT event_id, CAST(ts AS DATE) AS day,
  CASE WHEN event_id % 50 = 0 THEN 'not json' ELSE props END AS raw FROM events),
d AS (SELECT DISTINCT day FROM e UNION SELECT CAST(max(day) + INTERVAL 1 DAY AS DATE) FROM e),
p AS (SELECT *, CASE WHEN json_valid(raw) THEN COALESCE(json_type(raw) = 'OBJECT'
  AND TRY_CAST(json_extract_string(raw, '$.k') AS INTEGER) IS NOT NULL, FALSE) ELSE FALSE END AS ok FROM e WHERE day(day) % 7 <> 0),
g AS (SELECT day, count(*) AS row_count, count(*) FILTER (WHERE NOT ok) AS unparseable_rows, arg_min(ok, event_id) AS first_line_ok
  FROM p GROUP BY day)
SELECT d.day, COALESCE(row_count, 0) AS row_count, COALESCE(unparseable_rows, 0) AS unparseable_rows,
  COALESCE(first_line_ok, FALSE) AS first_line_ok FROM d LEFT JOIN g ON d.day = g.day
WHERE row_count IS NULL OR NOT first_line_ok""")
def q_input_present(spark, sf):
    """Input days that are listed but hold no row (each seventh, and the day after the last), or begin with a bad line."""
    day = F.col("ts").cast("date")
    e = feeds.table(spark, sf, "events").select("event_id", day.alias("day"), F.when(F.col("event_id") % 50 == 0, F.lit("not json"))
                                                .otherwise(F.col("props")).alias("raw"))
    listed = e.select("day").distinct().unionByName(e.agg(F.date_add(F.max("day"), 1).alias("day")))
    return checks.input_parseable(e.where(F.dayofmonth("day") % 7 != 0), "day", "event_id", "raw", "k int", listed)


@query("check_snapshot_differences", f"""WITH s AS ({O.ACCOUNT_REPLAY}),
w AS (SELECT * REPLACE (CASE WHEN o_custkey = (SELECT min(o_custkey) FROM s) THEN NULL ELSE o_totalprice END AS o_totalprice)
  FROM ({WH_ACCOUNT_SQL}) __w)
SELECT COALESCE(s.o_custkey, w.o_custkey) AS o_custkey, COALESCE(s.start_date, w.start_date) AS start_date,
  CASE WHEN w.o_custkey IS NULL THEN 'missing_in_warehouse' WHEN s.o_custkey IS NULL THEN 'missing_in_snapshot'
       ELSE 'different' END AS issue
FROM s FULL OUTER JOIN w ON s.o_custkey = w.o_custkey AND s.start_date = w.start_date
WHERE w.o_custkey IS NULL OR s.o_custkey IS NULL OR
  ({' OR '.join(f's.{f} IS DISTINCT FROM w.{f}' for f in EQ_FIELDS)})""")
def q_snapshot_differences(spark, sf):
    """One customer's amounts were lost in the warehouse: digests find its buckets, and only those are joined."""
    s = account_replay(spark, sf).checkpoint(eager=True)
    least = s.select(F.min(K).alias(K))
    w = wh_account(spark, sf).join(F.broadcast(least.withColumn("hit", F.lit(True))), K, "left").withColumn(
        "o_totalprice", F.when(F.col("hit"), F.lit(None)).otherwise(F.col("o_totalprice"))).drop("hit")
    return checks.snapshot_differences(s, w.checkpoint(eager=True), [K, "start_date"], EQ_FIELDS)
