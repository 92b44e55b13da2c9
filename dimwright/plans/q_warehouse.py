"""Queries: shaping, surrogate keys, merges, calendar, fact, marts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from dimwright.operators import keys, marts, scd, shape, warehouse
from dimwright.operators.plan_utils import spread
from dimwright.plans import feeds
from dimwright.plans import oracle as O
from dimwright.plans.feeds import ACCOUNT, FACT, NATION, SEGMENT
from dimwright.plans.q_scd import (NATION_ROWS_SQL, YEARS, _no_dedup, _segment_rows_sql, account_replay, batch_rows,
                                   nation_rows, run_col, segment_rows)
from dimwright.plans.registry import query
from dimwright.session import ensure_checkpoint_dir

# ---------------------------------------------------------------- shaping (part)

PART_RENAMES = (("p_partkey", "source_part_id"), ("p_brand", "brand_code"))
PART_DERIVED = (
    ("size_tier", "CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END"),
    ("price_band", "CAST(floor(p_retailprice / 100) AS INT)"),
    ("is_active", "TRUE"),
)


def _derived_sql(derived) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in derived)


@query("dim_rename_derive", f"""SELECT p_partkey AS source_part_id, p_name, p_brand AS brand_code,
  p_type, p_size, p_retailprice, {_derived_sql(PART_DERIVED)} FROM part""")
def q_rename_derive(spark, sf):
    p = feeds.table(spark, sf, "part")
    return shape.derive(shape.rename(p, PART_RENAMES), PART_DERIVED)


PART_COLUMNS = ["source_part_id", "brand_code", "size_tier", "p_retailprice", "supplier_note"]


@query("dim_align_columns", """SELECT p_partkey AS source_part_id, p_brand AS brand_code,
  CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_tier,
  p_retailprice, CAST(NULL AS VARCHAR) AS supplier_note FROM part""")
def q_align(spark, sf):
    """Fixed order, missing column as typed NULL, extra columns dropped."""
    return shape.align(q_rename_derive(spark, sf), PART_COLUMNS)


@query("dim_cast_load", """SELECT CAST(p_partkey AS BIGINT) AS source_part_id,
  CAST(p_retailprice AS DECIMAL(10,2)) AS p_retailprice,
  CAST(p_size AS SMALLINT) AS p_size,
  TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_number,
  TRY_CAST(p_name AS INTEGER) AS name_as_number FROM part""")
def q_cast(spark, sf):
    """Warehouse types: decimal money (HALF_UP), narrow ints, try_cast of strings."""
    p = feeds.table(spark, sf, "part").select(
        F.col("p_partkey").alias("source_part_id"), "p_retailprice", "p_size",
        F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)).alias("brand_number"),
        F.col("p_name").alias("name_as_number"))
    return shape.cast_to(p, {"source_part_id": "bigint", "p_retailprice": "decimal(10,2)",
                             "p_size": "smallint", "brand_number": "int", "name_as_number": "int"})


# ---------------------------------------------------------------- warehouse dims

def star(spark, sf) -> dict:
    """Warehouse dimensions with surrogate keys, and the fact, built once.

    The three dimensions share one deduped feed, materialised once (reliable
    checkpoint) instead of being re-derived from the raw scan per dimension;
    each key assignment materialises its dimension once.  The dimensions do not
    depend on each other, so their jobs run side by side.
    """
    ensure_checkpoint_dir(spark)
    rows = feeds.account_rows(spark, sf).checkpoint(eager=True)
    prepared = ((scd.prepare(rows, _no_dedup(ACCOUNT)), ACCOUNT), (nation_rows(spark, sf, rows), NATION), (segment_rows(spark, sf, rows), SEGMENT))
    with ThreadPoolExecutor(len(prepared)) as pool:
        acc, nat, seg = pool.map(lambda p: warehouse.warehouse_dimension(scd.replay(p[0], p[1], run_col()), p[1]), prepared)
    f = warehouse.fact_rows(acc, ACCOUNT, FACT, {"dim_nation": nat, "dim_segment": seg})
    return {"dim_account": acc, "dim_nation": nat, "dim_segment": seg, "fact": f}


def wh_account(spark, sf):
    return warehouse.warehouse_dimension(account_replay(spark, sf), ACCOUNT)


def fact(spark, sf):
    return star(spark, sf)["fact"]


WH_ACCOUNT_SQL = (f"SELECT *, row_number() OVER (ORDER BY o_custkey, start_date) AS account_id "
                  f"FROM ({O.ACCOUNT_REPLAY}) __a")
WH_NATION_SQL = (f"SELECT *, row_number() OVER (ORDER BY c_nationkey) AS nation_id "
                 f"FROM ({O.replay_sql(NATION_ROWS_SQL, NATION)}) __n")
WH_SEGMENT_SQL = (f"SELECT *, row_number() OVER (ORDER BY c_mktsegment) AS segment_id "
                  f"FROM ({O.replay_sql(_segment_rows_sql(), SEGMENT)}) __s")
FACT_SQL = f"""SELECT a.account_id, n.nation_id, s.segment_id,
  CAST(strftime(a.source_batch_date, '%Y%m%d') AS INTEGER) AS date_id, a.o_totalprice AS order_amount
FROM ({WH_ACCOUNT_SQL}) a JOIN ({WH_NATION_SQL}) n ON a.c_nationkey = n.c_nationkey
JOIN ({WH_SEGMENT_SQL}) s ON a.c_mktsegment = s.c_mktsegment"""


@query("surrogate_keys", WH_ACCOUNT_SQL)
def q_surrogate(spark, sf):
    return wh_account(spark, sf)


@query("fact_load", FACT_SQL)
def q_fact(spark, sf):
    return fact(spark, sf)


def calendar_sql(where: str = "TRUE") -> str:
    return f"""WITH b AS (SELECT min(source_batch_date) lo, max(source_batch_date) hi
  FROM ({O.RAW_ORDERS}) __o WHERE {where}),
d AS (SELECT CAST(unnest(generate_series(make_date(CAST(year(lo) AS INTEGER), 1, 1),
  make_date(CAST(year(hi) AS INTEGER), 12, 31), INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_id, date,
  CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name,
  CAST(day(date) AS INTEGER) AS day, CAST(dayofweek(date) AS INTEGER) AS day_of_week,
  dayname(date) AS day_name, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
  dayofweek(date) IN (0, 6) AS is_weekend, day(date) = 1 AS is_month_start,
  date = last_day(date) AS is_month_end,
  day(date) = 1 AND month(date) IN (1, 4, 7, 10) AS is_quarter_start,
  date = CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS is_quarter_end
FROM d"""


@query("dim_date", calendar_sql())
def q_dim_date(spark, sf):
    return warehouse.calendar(feeds.raw_orders(spark, sf))


@query("merge_append_missing", calendar_sql())
def q_append_missing(spark, sf):
    """Calendar of 1995-1997 extended by the calendar of all batches (DO NOTHING)."""
    raw = feeds.raw_orders(spark, sf)
    target = warehouse.calendar(raw.where(F.year("source_batch_date") <= 1997))
    staging = warehouse.calendar(raw)
    return keys.merge_append_missing(target, staging, ["date_id"])


PENDING_RUNS = ("scd-1999", "scd-2000", "scd-2001")


def _runs_sql(runs) -> str:
    return ", ".join(f"'{r}'" for r in runs)


MERGE_SQL = f"""WITH t AS (SELECT *, row_number() OVER (ORDER BY o_custkey, start_date) AS account_id
  FROM ({O.replay_sql(O.account_rows_sql(O.year_filter(None, 1998)), ACCOUNT)}) __t),
s AS (SELECT * FROM ({O.ACCOUNT_REPLAY}) __s WHERE last_updated_run_id IN ({_runs_sql(PENDING_RUNS)})),
upd AS (SELECT s.* EXCLUDE (o_custkey, start_date), t.o_custkey, t.start_date, t.account_id
  FROM t JOIN s ON t.o_custkey = s.o_custkey AND t.start_date = s.start_date),
kept AS (SELECT t.* FROM t ANTI JOIN s ON t.o_custkey = s.o_custkey AND t.start_date = s.start_date),
ins AS (SELECT s.*, (SELECT max(account_id) FROM t)
           + row_number() OVER (ORDER BY s.o_custkey, s.start_date) AS account_id
  FROM s ANTI JOIN t ON t.o_custkey = s.o_custkey AND t.start_date = s.start_date)
SELECT * FROM upd UNION ALL BY NAME SELECT * FROM kept UNION ALL BY NAME SELECT * FROM ins"""


@query("merge_upsert", MERGE_SQL)
def q_merge_upsert(spark, sf):
    """Warehouse after 1995-1998, upserted with the rows the 1999-2001 runs touched."""
    early = scd.replay(batch_rows(spark, sf, [1995, 1996, 1997, 1998]), ACCOUNT, run_col())
    target = warehouse.warehouse_dimension(early, ACCOUNT)
    staging = account_replay(spark, sf).where(F.col("last_updated_run_id").isin(*PENDING_RUNS))
    return keys.merge_upsert(target, staging, list(ACCOUNT.nk_columns), "account_id")


# ---------------------------------------------------------------- marts

def _cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


MART_TIER_SQL = f"""WITH a AS ({WH_ACCOUNT_SQL}), s AS ({WH_SEGMENT_SQL}), f AS ({FACT_SQL})
SELECT s.c_mktsegment AS tier, COUNT(DISTINCT a.o_custkey) AS active_count,
  CAST((2 * SUM({_cents('f.order_amount')}) + COUNT(f.order_amount)) // (2 * COUNT(f.order_amount))
       AS DOUBLE) / 100.0 AS avg_amount,
  CAST(SUM({_cents('f.order_amount')}) AS DOUBLE) / 100.0 AS total_amount
FROM f JOIN a ON f.account_id = a.account_id JOIN s ON f.segment_id = s.segment_id
WHERE a.is_current AND a.o_orderstatus = 'O'
GROUP BY s.c_mktsegment"""


@query("mart_active_by_tier", MART_TIER_SQL)
def q_mart_tier(spark, sf):
    st = star(spark, sf)
    return marts.active_by_tier(
        st["fact"], st["dim_account"], st["dim_segment"],
        base_key="account_id", entity="o_custkey", tier_key="segment_id", tier_name="c_mktsegment",
        measure="order_amount", status_col="o_orderstatus", active_value="O")


MART_MONTH_SQL = f"""WITH a AS ({WH_ACCOUNT_SQL}), n AS ({WH_NATION_SQL}), f AS ({FACT_SQL}),
cal AS ({calendar_sql()})
SELECT cal.year, cal.month, cal.month_name, n.n_name AS group_name,
  COUNT(DISTINCT a.o_custkey) AS entity_count,
  CAST(SUM({_cents('f.order_amount')}) AS DOUBLE) / 100.0 AS total_amount
FROM f JOIN a ON f.account_id = a.account_id JOIN n ON f.nation_id = n.nation_id
JOIN cal ON f.date_id = cal.date_id
GROUP BY cal.year, cal.month, cal.month_name, n.n_name
ORDER BY cal.year, cal.month, n.n_name"""


@query("mart_amount_by_month_nation", MART_MONTH_SQL)
def q_mart_month(spark, sf):
    st = star(spark, sf)
    return marts.amount_by_month_and(
        st["fact"], st["dim_account"], st["dim_nation"],
        warehouse.calendar(feeds.raw_orders(spark, sf)),
        base_key="account_id", entity="o_custkey", other_key="nation_id", other_name="n_name",
        measure="order_amount")


TIER_MART = marts.MartSpec(name="open_by_tier", fact="fact_account", entity="o_custkey", measure="o_totalprice",
                           groups=(("tier", "c_mktsegment"),), where="is_current AND o_orderstatus = 'O'")
MONTH_MART = marts.MartSpec(name="amount_by_month_nation", fact="fact_account", entity="o_custkey", measure="o_totalprice",
                            groups=(("year", "year(source_batch_date)"), ("month", "month(source_batch_date)"), ("nation_key", "c_nationkey")))


def _kept_mart(spark, sf, spec):
    """Groups after all batches but the last two, then changed by the customers those two hold: no other customer is read again.

    What several steps read is materialised (reliable checkpoints), as the job reads stored tables: the state, the rows
    of the last two batches and the versions of their customers before them.
    """
    ensure_checkpoint_dir(spark)
    state = scd.replay(batch_rows(spark, sf, YEARS[:-2]), ACCOUNT, run_col()).checkpoint(eager=True)
    rows = batch_rows(spark, sf, YEARS[-2:]).checkpoint(eager=True)
    parts = feeds.order_parts(spark, sf)
    held = spread(rows.select("o_custkey"), parts, "o_custkey").distinct()
    before = spread(state, parts, "o_custkey").join(held, "o_custkey", "left_semi").checkpoint(eager=True)
    after = scd.apply_batches(before, rows, ACCOUNT, run_col(), parts)
    stored = marts.group_change(None, marts.pairs(state, spec), spec)
    return marts.merge_groups(stored, marts.group_change(marts.pairs(before, spec), marts.pairs(after, spec), spec), spec)


def _kept_mart_sql(groups: str, where: str = "TRUE") -> str:
    total = f"SUM({_cents('o_totalprice')})"
    return f"""SELECT {groups}, COUNT(DISTINCT o_custkey) AS entity_count, COUNT(*) AS row_count,
  CAST((2 * {total} + COUNT(o_totalprice)) // (2 * COUNT(o_totalprice)) AS DOUBLE) / 100.0 AS avg_amount,
  CAST({total} AS DOUBLE) / 100.0 AS total_amount
FROM ({O.ACCOUNT_REPLAY}) __a WHERE {where} GROUP BY ALL"""


@query("mart_kept_open_by_tier", _kept_mart_sql("c_mktsegment AS tier", "is_current AND o_orderstatus = 'O'"))
def q_kept_tier(spark, sf):
    return marts.served(_kept_mart(spark, sf, TIER_MART))


@query("mart_kept_amount_by_month_nation", _kept_mart_sql(
    "CAST(year(source_batch_date) AS INTEGER) AS year, CAST(month(source_batch_date) AS INTEGER) AS month, c_nationkey AS nation_key"))
def q_kept_month(spark, sf):
    return marts.served(_kept_mart(spark, sf, MONTH_MART))


HISTORY_COLUMNS = ["o_custkey", "start_date", "end_date", "is_current", "o_orderstatus",
                   "o_totalprice", "c_nationkey", "n_name", "c_mktsegment", "segment_label"]


@query("mart_version_history", f"""SELECT a.o_custkey, a.start_date, a.end_date, a.is_current,
  a.o_orderstatus, a.o_totalprice, a.c_nationkey, n.n_name, a.c_mktsegment, s.segment_label
FROM ({O.ACCOUNT_REPLAY}) a
LEFT JOIN ({O.replay_sql(NATION_ROWS_SQL, NATION)}) n ON a.c_nationkey = n.c_nationkey
LEFT JOIN ({O.replay_sql(_segment_rows_sql(), SEGMENT)}) s ON a.c_mktsegment = s.c_mktsegment
ORDER BY a.o_custkey, a.start_date""")
def q_history(spark, sf):
    nation = scd.replay(nation_rows(spark, sf), NATION, run_col())
    segment = scd.replay(segment_rows(spark, sf), SEGMENT, run_col())
    return marts.version_history(
        account_replay(spark, sf),
        [(nation, "c_nationkey", ["n_name"]), (segment, "c_mktsegment", ["segment_label"])],
        HISTORY_COLUMNS, ["o_custkey", "start_date"])
