"""DuckDB SQL oracles: the same bindings written as plain ANSI-ish SQL.

These strings are independent re-statements of each query (window SQL for
the SCD replay, recursive SQL for the fold semantics); the driver runs them
next to the Spark plans and compares results.
"""

from __future__ import annotations

from dimwright.contract import DimensionSpec
from dimwright.plans import feeds

OPEN_END = "DATE '2099-12-31'"

RAW_ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate,
  CAST(date_trunc('year', o_orderdate) AS DATE) AS source_batch_date,
  'run-' || strftime(o_orderdate, '%Y') AS processed_run_id
FROM orders"""


def dedup_sql(rows_sql: str, keys: str = "o_custkey, source_batch_date",
              order: str = "o_orderdate DESC, o_orderkey DESC") -> str:
    return (f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {keys} ORDER BY {order}) AS __rn FROM ({rows_sql}) __d) __e WHERE __rn = 1")


def enrich_sql(rows_sql: str) -> str:
    return (f"SELECT r.*, c.c_name, c.c_mktsegment, c.c_nationkey, n.n_name FROM ({rows_sql}) r "
            f"JOIN customer c ON r.o_custkey = c.c_custkey "
            f"JOIN nation n ON c.c_nationkey = n.n_nationkey")


def account_feed_sql() -> str:
    return enrich_sql(RAW_ORDERS)


def account_rows_sql(where: str = "TRUE") -> str:
    return enrich_sql(dedup_sql(f"SELECT * FROM ({RAW_ORDERS}) __r WHERE {where}"))


def scd_run_sql(batch: str = "source_batch_date") -> str:
    return f"'scd-' || strftime({batch}, '%Y')"


def year_filter(lo: int | None = None, hi: int | None = None, exclude: tuple[int, ...] = ()) -> str:
    conds = []
    if lo is not None:
        conds.append(f"year(source_batch_date) >= {lo}")
    if hi is not None:
        conds.append(f"year(source_batch_date) <= {hi}")
    for y in exclude:
        conds.append(f"year(source_batch_date) <> {y}")
    return " AND ".join(conds) or "TRUE"


def derived_select(spec: DimensionSpec) -> str:
    return "".join(f", {expr} AS {name}" for name, expr in spec.derived_fields)


def _dim_cols(spec: DimensionSpec) -> list[str]:
    return spec.columns()


def replay_sql(rows_sql: str, spec: DimensionSpec, run_expr: str | None = None) -> str:
    """Window formulation of the SCD fold (exact when tracked fields are never NULL)."""
    run_expr = run_expr or scd_run_sql(spec.batch_column)
    bk, b = spec.business_key, spec.batch_column
    cols = _dim_cols(spec)
    scd1 = [f for f in spec.scd1_fields if f in cols]
    meta = {"start_date", "end_date", "is_current", "last_updated_run_id"}
    opening = [c for c in cols if c not in scd1 and c not in meta and c != bk]
    chg = " OR ".join([f"LAG({b}) OVER w IS NULL"] +
                      [f"({f} IS NOT NULL AND {f} IS DISTINCT FROM LAG({f}) OVER w)"
                       for f in spec.scd2_fields])
    first_cols = ", ".join(f"first({c} ORDER BY {b}) AS {c}" for c in opening)
    scd1_cols = "".join(f", last({s} ORDER BY {b}) FILTER (WHERE {s} IS NOT NULL) AS {s}" for s in scd1)
    own_run = "__last_run" if scd1 else "__open_run"
    sel = []
    for c in cols:
        if c == "end_date":
            sel.append(f"COALESCE(CAST(LEAD(start_date) OVER w2 - INTERVAL 1 DAY AS DATE), "
                       f"{OPEN_END}) AS end_date")
        elif c == "is_current":
            sel.append("LEAD(start_date) OVER w2 IS NULL AS is_current")
        elif c == "last_updated_run_id":
            sel.append(f"COALESCE(LEAD(__open_run) OVER w2, {own_run}) AS last_updated_run_id")
        else:
            sel.append(c)
    return f"""WITH __r AS (SELECT *{derived_select(spec)}, {run_expr} AS __run FROM ({rows_sql}) __x
                 WHERE {bk} IS NOT NULL),
__c AS (SELECT *, CASE WHEN {chg} THEN 1 ELSE 0 END AS __chg FROM __r
        WINDOW w AS (PARTITION BY {bk} ORDER BY {b})),
__v AS (SELECT *, SUM(__chg) OVER (PARTITION BY {bk} ORDER BY {b}
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS __ver FROM __c),
__g AS (SELECT {bk}, __ver, MIN({b}) AS start_date, {first_cols}{scd1_cols},
        first(__run ORDER BY {b}) AS __open_run, last(__run ORDER BY {b}) AS __last_run
        FROM __v GROUP BY {bk}, __ver)
SELECT {', '.join(sel)} FROM __g WINDOW w2 AS (PARTITION BY {bk} ORDER BY start_date)"""


def fold_sql(rows_sql: str, spec: DimensionSpec, run_expr: str | None = None) -> str:
    """Recursive formulation: each row is compared with the OPEN version's values."""
    run_expr = run_expr or scd_run_sql(spec.batch_column)
    bk, b = spec.business_key, spec.batch_column
    cols = _dim_cols(spec)
    scd1 = [f for f in spec.scd1_fields if f in cols]
    meta = {"start_date", "end_date", "is_current", "last_updated_run_id"}
    opening = [c for c in cols if c not in scd1 and c not in meta and c != bk]
    tr = list(spec.scd2_fields)
    chg = " OR ".join(f"(r.{f} IS NOT NULL AND r.{f} IS DISTINCT FROM s.__t_{f})" for f in tr) or "FALSE"
    t_cols = ", ".join(f"__t_{f}" for f in tr)
    t_init = ", ".join(f"{f}" for f in tr)
    t_next = ", ".join(f"CASE WHEN {chg} THEN r.{f} ELSE s.__t_{f} END" for f in tr)
    first_cols = ", ".join(f"first({c} ORDER BY {b}) AS {c}" for c in opening)
    scd1_cols = "".join(f", last({s} ORDER BY {b}) FILTER (WHERE {s} IS NOT NULL) AS {s}" for s in scd1)
    own_run = "__last_run" if scd1 else "__open_run"
    sel = []
    for c in cols:
        if c == "end_date":
            sel.append(f"COALESCE(CAST(LEAD(start_date) OVER w2 - INTERVAL 1 DAY AS DATE), "
                       f"{OPEN_END}) AS end_date")
        elif c == "is_current":
            sel.append("LEAD(start_date) OVER w2 IS NULL AS is_current")
        elif c == "last_updated_run_id":
            sel.append(f"COALESCE(LEAD(__open_run) OVER w2, {own_run}) AS last_updated_run_id")
        else:
            sel.append(c)
    return f"""WITH RECURSIVE __r AS (SELECT *{derived_select(spec)}, {run_expr} AS __run,
        row_number() OVER (PARTITION BY {bk} ORDER BY {b}) AS __i
        FROM ({rows_sql}) __x WHERE {bk} IS NOT NULL),
__s({bk}, __i, __ver, {t_cols}) AS (
  SELECT {bk}, __i, 1, {t_init} FROM __r WHERE __i = 1
  UNION ALL
  SELECT r.{bk}, r.__i, s.__ver + CASE WHEN {chg} THEN 1 ELSE 0 END, {t_next}
  FROM __s s JOIN __r r ON r.{bk} = s.{bk} AND r.__i = s.__i + 1),
__v AS (SELECT r.*, s.__ver FROM __r r JOIN __s s ON r.{bk} = s.{bk} AND r.__i = s.__i),
__g AS (SELECT {bk}, __ver, MIN({b}) AS start_date, {first_cols}{scd1_cols},
        first(__run ORDER BY {b}) AS __open_run, last(__run ORDER BY {b}) AS __last_run
        FROM __v GROUP BY {bk}, __ver)
SELECT {', '.join(sel)} FROM __g WINDOW w2 AS (PARTITION BY {bk} ORDER BY start_date)"""


def initial_sql(rows_sql: str, spec: DimensionSpec, run: str) -> str:
    sel = []
    for c in _dim_cols(spec):
        if c == "start_date":
            sel.append(f"CAST({spec.batch_column} AS DATE) AS start_date")
        elif c == "end_date":
            sel.append(f"{OPEN_END} AS end_date")
        elif c == "is_current":
            sel.append("TRUE AS is_current")
        elif c == "last_updated_run_id":
            sel.append(f"{run} AS last_updated_run_id")
        else:
            sel.append(c)
    return f"SELECT {', '.join(sel)} FROM (SELECT *{derived_select(spec)} FROM ({rows_sql}) __x) __y"


ACCOUNT_ROWS_ALL = account_rows_sql()
ACCOUNT_REPLAY = replay_sql(ACCOUNT_ROWS_ALL, feeds.ACCOUNT)
