"""Queries: ingestion (schema, lineage, discovery, pending scans) and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimwright.contract import FieldRules, Rule
from dimwright.operators import ingest, validate
from dimwright.plans import feeds
from dimwright.plans import oracle as O
from dimwright.plans.feeds import ORDER_RULES
from dimwright.plans.registry import query
from dimwright.sources.jsonl import parse_json_column

# ---------------------------------------------------------------- SQL helpers


def rule_sql(field: str, rule: Rule) -> str:
    f = field
    if rule.name == "notNull":
        return f"CASE WHEN {f} IS NULL THEN 'notNull' END"
    if rule.name == "notEmpty":
        return f"CASE WHEN {f} IS NOT NULL AND trim(CAST({f} AS VARCHAR)) = '' THEN 'notEmpty' END"
    if rule.name == "regex":
        p = str(rule.param).replace("'", "''")
        return (f"CASE WHEN {f} IS NOT NULL AND NOT regexp_matches(CAST({f} AS VARCHAR), '{p}') "
                f"THEN 'regex: {p}' END")
    op = "<" if rule.name == "minValue" else ">"
    return (f"CASE WHEN {f} IS NOT NULL AND TRY_CAST({f} AS DOUBLE) {op} {float(rule.param)} "
            f"THEN '{rule.name}: {rule.param}' END")


def errors_long_sql(src: str, key: str, rules: tuple[FieldRules, ...], present: set[str] | None = None) -> str:
    parts = []
    for fr in rules:
        if present is not None and fr.field not in present:
            parts.append(f"SELECT {key}, '{fr.field}' AS field, 'fieldMissing' AS code FROM ({src}) __s")
            continue
        for r in fr.rules:
            parts.append(f"SELECT * FROM (SELECT {key}, '{fr.field}' AS field, {rule_sql(fr.field, r)} "
                         f"AS code FROM ({src}) __s) __t WHERE code IS NOT NULL")
    return " UNION ALL ".join(parts)


def any_error_sql(rules: tuple[FieldRules, ...]) -> str:
    return "COALESCE(" + ", ".join(rule_sql(fr.field, r) for fr in rules for r in fr.rules) + ")"


FAULTED_SQL = f"""SELECT o_orderkey,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 41 = 0 THEN '' WHEN o_orderkey % 43 = 0 THEN '   '
       WHEN o_orderkey % 47 = 0 THEN chr(9) WHEN o_orderkey % 53 = 0 THEN NULL ELSE c_name END AS c_name,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 'X' ELSE o_orderstatus END
    AS o_orderstatus,
  CASE WHEN o_orderkey % 59 = 0 THEN 'urgent' ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 29 = 0 THEN CAST(-5.0 AS DOUBLE) WHEN o_orderkey % 61 = 0 THEN CAST('NaN' AS DOUBLE)
       WHEN o_orderkey % 67 = 0 THEN CAST(1000.0 AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
  c_mktsegment, c_nationkey, n_name, o_orderdate, source_batch_date, processed_run_id
FROM ({O.account_feed_sql()}) __f"""

CLASSIFIED_SQL = (f"SELECT *, CASE WHEN {any_error_sql(ORDER_RULES)} IS NULL THEN 'valid' "
                  f"ELSE 'invalid' END AS record_status FROM ({FAULTED_SQL}) __c")


def classified(spark, sf):
    return validate.classify(feeds.faulted_orders(spark, sf), ORDER_RULES)


# ---------------------------------------------------------------- ingestion


@query("ingest_schema_enforce", """SELECT event_id,
  CASE WHEN json_valid(raw) THEN TRY_CAST(json_extract_string(raw, '$.k') AS INTEGER) END AS k
FROM (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'not json'
  WHEN event_id % 77 = 0 THEN '{"k": "zz"}' WHEN event_id % 91 = 0 THEN '' ELSE props END AS raw
  FROM events) __e""")
def q_schema_enforce(spark, sf):
    """Declared schema over JSON text: malformed text and wrong types become NULL."""
    e = feeds.table(spark, sf, "events")
    i = F.col("event_id")
    raw = (F.when(i % 50 == 0, F.lit("not json")).when(i % 77 == 0, F.lit('{"k": "zz"}'))
           .when(i % 91 == 0, F.lit("")).otherwise(F.col("props")))
    return e.select("event_id", parse_json_column(raw, "k int").alias("p")).select("event_id", "p.k")


@query("ingest_lineage", f"""SELECT o_orderkey, o_custkey, source_batch_date, processed_run_id
FROM ({O.RAW_ORDERS}) __o""")
def q_lineage(spark, sf):
    o = feeds.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    b = feeds.batch_of(F.col("o_orderdate"))
    return ingest.stamp_lineage(o, b, F.concat(F.lit("run-"), F.date_format(b, "yyyy"))) \
        .drop("o_orderdate")


@query("ingest_batch_discovery", r"""SELECT DISTINCT CAST(TRY_STRPTIME(regexp_extract(path,
  'batch-(\d{4}-\d{2}-\d{2})', 1), '%Y-%m-%d') AS DATE) AS batch_date
FROM (SELECT CASE WHEN o_orderkey % 101 = 0 THEN 's3a://order-drops/batch-1999-13-45/input.jsonl'
  WHEN o_orderkey % 103 = 0 THEN 's3a://order-drops/tmp/input.jsonl'
  ELSE 's3a://order-drops/batch-' || strftime(o_orderdate, '%Y-%m-%d') || '/input.jsonl' END AS path
  FROM orders) __p WHERE batch_date IS NOT NULL ORDER BY batch_date""")
def q_discovery(spark, sf):
    k = F.col("o_orderkey")
    paths = feeds.table(spark, sf, "orders").select(
        F.when(k % 101 == 0, F.lit("s3a://order-drops/batch-1999-13-45/input.jsonl"))
        .when(k % 103 == 0, F.lit("s3a://order-drops/tmp/input.jsonl"))
        .otherwise(F.concat(F.lit("s3a://order-drops/batch-"), F.date_format("o_orderdate", "yyyy-MM-dd"),
                            F.lit("/input.jsonl"))).alias("path"))
    return ingest.batch_dates_from_paths(paths, "path")


def _available(spark, sf):
    return feeds.raw_orders(spark, sf).select(F.col("source_batch_date").alias("batch_date")).distinct()


def _completed(spark, sf, upto: int = 1998):
    """Synthetic control rows: batches through ``upto`` were applied earlier."""
    return _available(spark, sf).where(F.year("batch_date") <= upto)


@query("state_pending_batches", f"""SELECT DISTINCT source_batch_date AS batch_date FROM ({O.RAW_ORDERS}) __o
WHERE year(source_batch_date) > 1998 ORDER BY batch_date""")
def q_pending_batches(spark, sf):
    return ingest.pending_batches(_available(spark, sf), _completed(spark, sf))


@query("ingest_pending_scan", f"SELECT * FROM ({O.account_feed_sql()}) __f WHERE year(source_batch_date) > 1998")
def q_pending_scan(spark, sf):
    pending = ingest.pending_batches(_available(spark, sf), _completed(spark, sf))
    return ingest.pending_scan(feeds.account_feed(spark, sf), pending)


# ---------------------------------------------------------------- validation


@query("validate_rules", errors_long_sql(FAULTED_SQL, "o_orderkey", ORDER_RULES))
def q_rules(spark, sf):
    return validate.violations(feeds.faulted_orders(spark, sf), ORDER_RULES, ["o_orderkey"])


SUPPLIER_RULES = (
    FieldRules("s_name", (Rule("notNull"), Rule("notEmpty"))),
    FieldRules("s_phone", (Rule("regex", "^[0-9-]+$"),)),
    FieldRules("s_acctbal", (Rule("notNull"), Rule("minValue", 0))),
)


@query("validate_field_missing", errors_long_sql("SELECT * FROM supplier", "s_suppkey", SUPPLIER_RULES,
                                                 present={"s_name", "s_acctbal"}))
def q_field_missing(spark, sf):
    """A rule on an absent column flags every row 'fieldMissing'."""
    return validate.violations(feeds.table(spark, sf, "supplier"), SUPPLIER_RULES, ["s_suppkey"])


@query("validate_valid", f"SELECT * FROM ({FAULTED_SQL}) __f WHERE {any_error_sql(ORDER_RULES)} IS NULL")
def q_valid(spark, sf):
    valid, _ = validate.split_valid_invalid(feeds.faulted_orders(spark, sf), ORDER_RULES)
    return valid


@query("validate_invalid", f"""SELECT o_orderkey, string_agg(DISTINCT field, ',' ORDER BY field) AS error_fields,
  string_agg(code, '|' ORDER BY code) AS error_codes
FROM ({errors_long_sql(FAULTED_SQL, "o_orderkey", ORDER_RULES)}) __e GROUP BY o_orderkey""")
def q_invalid(spark, sf):
    _, invalid = validate.split_valid_invalid(feeds.faulted_orders(spark, sf), ORDER_RULES)
    return invalid.select(
        "o_orderkey",
        F.array_join(F.array_sort(F.map_keys("validation_errors")), ",").alias("error_fields"),
        F.array_join(F.array_sort(F.flatten(F.map_values("validation_errors"))), "|").alias("error_codes"))
