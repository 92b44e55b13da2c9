import math

import pytest
from pyspark.sql import functions as F

from dimwright.contract import FieldRules, Rule
from dimwright.functions.rules import rule_column
from dimwright.operators import dq, validate
from dimwright.sources.jsonl import parse_json_column


def codes(spark, values, rule, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    out = df.select("i", rule_column("v", rule.name, rule.param).alias("c")).orderBy("i").collect()
    return [r["c"] for r in out]


def test_not_null_and_not_empty(spark):
    vals = [None, "", "  ", "\t", "x\n", "ok"]
    assert codes(spark, vals, Rule("notNull")) == ["notNull", None, None, None, None, None]
    # trim strips spaces only: a tab or a newline is content
    assert codes(spark, vals, Rule("notEmpty")) == [None, "notEmpty", "notEmpty", None, None, None]


def test_regex_search_semantics_and_trailing_newline(spark):
    r = Rule("regex", "^[a-z]+$")
    got = codes(spark, ["abc", "abc1", None, "abc\n", "x abc"], r)
    # Java '$' also matches before a final line terminator
    assert got == [None, "regex: ^[a-z]+$", None, None, "regex: ^[a-z]+$"]
    assert codes(spark, ["it's"], Rule("regex", "^it's$")) == [None]


def test_min_max_bounds_nan_and_non_numeric(spark):
    lo, hi = Rule("minValue", 50), Rule("maxValue", 5000)
    vals = [49.99, 50.0, 5000.0, 5000.01, float("nan"), None]
    assert codes(spark, vals, lo, "double") == ["minValue: 50", None, None, None, None, None]
    assert codes(spark, vals, hi, "double") == [None, None, None, "maxValue: 5000", "maxValue: 5000", None]
    # a non-numeric string is not comparable: no error (ANSI-safe try_cast)
    assert codes(spark, ["abc", "10"], lo) == [None, "minValue: 50"]


def test_unknown_rule_raises():
    with pytest.raises(ValueError):
        rule_column("x", "isEven", None)


def test_split_valid_invalid_and_error_map(spark):
    df = spark.createDataFrame([("a", 10.0), (None, 1.0), ("", None)], "name string, amount double")
    rules = [FieldRules("name", (Rule("notNull"), Rule("notEmpty"))),
             FieldRules("amount", (Rule("notNull"), Rule("minValue", 5)))]
    valid, invalid = validate.split_valid_invalid(df, rules)
    assert valid.columns == ["name", "amount"]
    assert [r["name"] for r in valid.collect()] == ["a"]
    errs = {(r["name"], r["amount"]): r["validation_errors"] for r in invalid.collect()}
    assert errs[(None, 1.0)] == {"name": ["notNull"], "amount": ["minValue: 5"]}
    assert errs[("", None)] == {"name": ["notEmpty"], "amount": ["notNull"]}


def test_field_missing(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    rules = [FieldRules("ghost", (Rule("notNull"), Rule("regex", "x")))]
    valid, invalid = validate.split_valid_invalid(df, rules)
    assert valid.count() == 0
    assert [r["validation_errors"] for r in invalid.collect()] == [{"ghost": ["fieldMissing"]}] * 2


def test_column_ending_in_error_is_kept(spark):
    df = spark.createDataFrame([("x", "y")], "a string, parse_error string")
    valid, _ = validate.split_valid_invalid(df, [FieldRules("a", (Rule("notNull"),))])
    assert valid.columns == ["a", "parse_error"]


def test_malformed_json_lines(spark, tmpdir_path):
    lines = ['{"a":1}', "not json", '{"a":"zz"}', "", '{"b":null}']
    p = f"{tmpdir_path}/in.jsonl"
    with open(p, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    df = spark.read.schema("a int, b string").option("mode", "PERMISSIVE").json(p)
    got = sorted(((r["a"], r["b"]) for r in df.collect()), key=repr)
    # blank line vanishes; unparsable line -> all-NULL row; wrong type -> NULL
    assert len(got) == 4
    assert got.count((None, None)) == 3 and (1, None) in got
    col = spark.createDataFrame([(s,) for s in lines], "t string").select(
        parse_json_column(F.col("t"), "a int").alias("p")).select("p.a")
    assert sorted([r["a"] for r in col.collect()], key=lambda x: (x is None, x)) == [1, None, None, None, None]


def test_duplicate_rate_null_key_counts_once(spark):
    df = spark.createDataFrame([("1",), ("1",), (None,), (None,)], "k string")
    r = dq.duplicate_rate(df, ["k"]).first()
    assert (r["total_records"], r["distinct_keys"], r["duplicate_rate"]) == (4, 2, 50.0)


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(1, 800)], "a long, b long")
    from dimwright.functions.money import rounded_pct
    assert df.select(rounded_pct(F.col("a"), F.col("b")).alias("p")).first()["p"] == 0.13


def test_reconciliation_difference(spark):
    inputs = spark.createDataFrame([("2024-01-01", 3)], "source_batch_date string, input_record_count long") \
        .withColumn("source_batch_date", F.col("source_batch_date").cast("date"))
    out = spark.createDataFrame([("2024-01-01", "valid"), ("2024-01-01", "invalid")],
                                "source_batch_date string, record_status string") \
        .withColumn("source_batch_date", F.col("source_batch_date").cast("date"))
    rec = dq.reconciliation(inputs, out, "source_batch_date").where("is_total").first()
    assert rec["difference"] == 1 and rec["output_total"] == 2
    assert not math.isnan(rec["input_records"])


def test_split_write_as_json_and_read_back(spark, tmpdir_path):
    from dimwright.sources import sinks
    df = spark.createDataFrame([("a", "2024-01-01"), (None, "2024-01-01"), ("b", "2024-01-02")],
                               "name string, d string").withColumn("source_batch_date", F.col("d").cast("date"))
    c = validate.classify(df.drop("d"), [FieldRules("name", (Rule("notNull"),))])
    sinks.write_split(c, f"{tmpdir_path}/out", fmt="json")
    back = spark.read.json(f"{tmpdir_path}/out")
    assert back.where("record_status = 'invalid'").count() == 1
    assert back.where("record_status = 'valid'").count() == 2
    # a row that changes its status leaves the other set
    fixed = c.where("source_batch_date = '2024-01-01'").withColumn("record_status", F.lit("valid"))
    sinks.write_split(fixed, f"{tmpdir_path}/out", fmt="json")
    back = spark.read.json(f"{tmpdir_path}/out")
    assert (back.count(), back.where("record_status = 'invalid'").count()) == (3, 0)
    # a batch without rows is cleared when named
    sinks.write_split(c.limit(0), f"{tmpdir_path}/out", fmt="json", batches=["2024-01-01"])
    assert spark.read.json(f"{tmpdir_path}/out").count() == 1
    sinks.write_split(fixed, f"{tmpdir_path}/out", fmt="json")
    # re-running one batch replaces only its partitions
    sinks.write_split(c.where("source_batch_date = '2024-01-02'"), f"{tmpdir_path}/out", fmt="json")
    assert spark.read.json(f"{tmpdir_path}/out").count() == 3


def test_duplicate_rates_by_status_match_per_set(spark):
    df = spark.createDataFrame([("1", "valid"), ("1", "valid"), (None, "valid"), ("2", "invalid"),
                                ("2", "invalid"), ("2", "invalid"), (None, "invalid")],
                               "k string, record_status string")
    both = {r["record_status"]: r["duplicate_rate"] for r in dq.duplicate_rates_by_status(df, ["k"]).collect()}
    for st in ("valid", "invalid"):
        assert both[st] == dq.duplicate_rate(df.where(F.col("record_status") == st), ["k"]).first()["duplicate_rate"]
    assert both == {"valid": 33.33, "invalid": 50.0}
