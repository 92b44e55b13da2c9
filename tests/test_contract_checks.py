import json

import pytest
from pyspark.sql import functions as F

from dimwright.contract import ContractError, FeedSpec, build_schema, contract_from_dict
from dimwright.operators import checks, dq, validate
from dimwright.plans import feeds
from dimwright.plans.feeds import ORDER_RULES
from dimwright.sources.jsonl import read_source

from support import SF001
from test_job import META


def test_schema_rejects_unknown_types():
    with pytest.raises(ContractError):
        build_schema({"type": "struct", "fields": [{"name": "a", "type": "decimal"}]})
    with pytest.raises(ContractError):
        build_schema({"type": "struct", "fields": []})
    with pytest.raises(ContractError):
        build_schema({"type": "struct"})


def test_contract_validation_catches_bad_rules_and_measures():
    bad = {**META, "ingestion": {**META["ingestion"], "validations": [{"field": "o_custkey", "rules": ["isEven"]}]}}
    with pytest.raises(ContractError):
        contract_from_dict(bad)
    bad2 = {**META, "star_schema": {"facts": [{"target_table": "f", "measures": {"m": {"source": "nope"}}}]}}
    with pytest.raises(ContractError):
        contract_from_dict(bad2)


def test_optional_source_missing_is_skipped(spark, tmpdir_path):
    feed = FeedSpec(name="x", path=f"{tmpdir_path}/batch-{{date}}/in*.jsonl", required=False)
    assert read_source(spark, feed, "2024-01-01") is None
    with pytest.raises(FileNotFoundError):
        read_source(spark, FeedSpec(name="y", path=feed.path, required=True), "2024-01-01")


def test_breakdown_contains_every_rule_type(spark):
    _, invalid = validate.split_valid_invalid(feeds.faulted_orders(spark, SF001), ORDER_RULES)
    codes = {r["code"].split(":")[0] for r in dq.error_breakdown(invalid).collect()}
    assert {"notNull", "notEmpty", "regex", "minValue", "maxValue"} <= codes


def test_history_exists_and_checks_pass_on_clean_replay(spark):
    from dimwright.plans.q_scd import account_replay
    d = account_replay(spark, SF001)
    assert d.groupBy("o_custkey").count().where("count > 1").count() > 0
    assert d.where(~F.col("is_current")).count() > 0
    for v in (checks.one_current(d, "o_custkey"), checks.current_is_latest(d, "o_custkey"),
              checks.natural_key_dups(d, ["o_custkey", "start_date"]), checks.start_eq_batch(d, "o_custkey"),
              checks.open_sentinel(d, "o_custkey"), checks.gapless_versions(d, "o_custkey"),
              checks.versions_differ(d, "o_custkey", ["o_orderstatus"])):
        assert v.count() == 0


def test_empty_inputs_are_reported(spark):
    raw = spark.createDataFrame([("f1", 1, '{"k": 1}'), ("f2", 1, "bad"), ("f2", 2, '{"k": 1}')], "f string, i long, t string")
    files = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "f string")
    got = {r["f"]: (r["row_count"], r["unparseable_rows"]) for r in checks.input_parseable(raw, "f", "i", "t", "k int", files).collect()}
    assert got == {"f2": (2, 1), "f3": (0, 0)}


def test_stored_metrics_row_is_checked(spark):
    good = dict(run_id="a", input_records=10, total_records=10, valid_records=7, invalid_records=3, reconciliation_difference=0,
                per_batch_valid='{"2024-01-01": 7}', per_batch_invalid='{"2024-01-01": 3}', batch_count=1, valid_rate=70.0, invalid_rate=30.0)
    bad = {**good, "run_id": "b", "invalid_records": 4, "valid_rate": 60.0}
    lost = {**good, "run_id": "c", "input_records": 12, "reconciliation_difference": 2}
    got = [(r["run_id"], r["issue"]) for r in checks.dq_row_consistent(spark.createDataFrame([good, bad, lost])).collect()]
    assert sorted(got) == [("b", "per_batch_invalid"), ("b", "rates"), ("b", "total"), ("c", "lost_records")]


def test_contract_rejects_unknown_names():
    meta = json.loads(json.dumps(META))
    meta["ingestion"]["validations"].append({"field": "nowhere", "rules": ["notNull"]})
    with pytest.raises(ContractError, match="nowhere"):
        contract_from_dict(meta)
    meta = json.loads(json.dumps(META))
    meta["dim_nation"]["natural_key_columns"] = ["no_such_column"]
    with pytest.raises(ContractError, match="no_such_column"):
        contract_from_dict(meta)
