"""End-to-end job on JSON-lines batches derived from the driver tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dimwright.contract import contract_from_dict
from dimwright.operators import dq, keys, marts, scd
from dimwright.plans import feeds
from dimwright.plans.job import Pipeline, PipelineError
from dimwright.sources import sinks

from support import SF001

# A contract in the metadata layout (ingestion / dimension_* / star_schema / dq sections).
META = {
    "ingestion": {
        "source": {
            "name": "order_feed", "path": "part-*.json", "format": "json", "required": True,
            "schema": {"type": "struct", "fields": [
                {"name": "o_orderkey", "type": "long"}, {"name": "o_custkey", "type": "long"},
                {"name": "o_orderstatus", "type": "string"}, {"name": "o_orderpriority", "type": "string"},
                {"name": "o_totalprice", "type": "double"}, {"name": "o_orderdate", "type": "date"},
                {"name": "c_name", "type": "string"}, {"name": "c_mktsegment", "type": "string"},
                {"name": "c_nationkey", "type": "integer"}, {"name": "n_name", "type": "string"}]},
            "schema_enforcement": {"enabled": True}, "options": {"multiLine": False}},
        "validations": [
            {"field": "o_custkey", "rules": ["notNull"]},
            {"field": "o_orderstatus", "rules": ["notNull", {"name": "regex", "params": "^(F|O|P)$"}]},
            {"field": "o_totalprice", "rules": ["notNull", {"name": "minValue", "params": 1000}]},
            {"field": "c_mktsegment", "rules": ["notNull", "notEmpty"]},
        ],
    },
    "scd_defaults": {"scd_sentinel_dates": {"end_date_open": "2099-12-31"}},
    "dimension_registry": ["dim_account", "dim_nation", "dim_segment"],
    "dimension_defaults": {"contract_version": "1.0", "batch_order_column": "source_batch_date",
                           "lineage_columns": ["source_batch_date", "processed_run_id", "ingestion_dt"]},
    "dim_account": {
        "deduplication": {"enabled": True, "key_column": "o_custkey"},
        "field_renames": {"o_custkey": "account_key"},
        "business_key": "account_key",
        "natural_key_columns": ["account_key", "start_date"],
        "scd_type_1_fields": ["o_orderpriority", "o_totalprice"],
        "scd_type_2_fields": ["o_orderstatus"],
        "non_tracked_fields": ["c_name", "c_mktsegment", "c_nationkey"],
        "metadata_columns": ["start_date", "end_date", "is_current", "last_updated_run_id"],
    },
    "dim_nation": {
        "deduplication": {"enabled": True, "key_column": "c_nationkey"},
        "business_key": "c_nationkey", "scd_type_1_fields": ["n_name"],
        "metadata_columns": ["last_updated_run_id"],
    },
    "dim_segment": {
        "deduplication": {"enabled": True, "key_column": "c_mktsegment"},
        "business_key": "c_mktsegment", "non_tracked_fields": ["segment_label", "is_active"],
        "derived_fields": [
            {"name": "segment_label", "expression": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'construction' ELSE 'other' END"},
            {"name": "is_active", "expression": "TRUE"}],
        "metadata_columns": ["last_updated_run_id"],
    },
    "star_schema": {"facts": [{"target_table": "fact_account",
                               "measures": {"order_amount": {"source": "o_totalprice"}}}]},
    "dq": {"uniqueness": {"key_columns": ["o_custkey"]}},
}

COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate",
        "c_name", "c_mktsegment", "c_nationkey", "n_name"]


def write_batch(spark, root, year):
    rows = feeds.account_feed(spark, SF001).where(F.year("o_orderdate") == year).select(*COLS)
    # deterministic faults so the invalid set is not empty
    rows = rows.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 13 == 0, F.lit("?"))
                           .otherwise(F.col("o_orderstatus")))
    rows.coalesce(2).write.mode("overwrite").json(f"{root}/batch-{year}-01-01")


def table_rows(df, drop=()):
    cols = sorted(c for c in df.columns if c not in drop)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def contract():
    return contract_from_dict(META)


def expected_dim(p, spec, run_id):
    valid = p.valid_rows(None)
    return scd.replay(scd.prepare(valid, spec), spec, run_id)


def test_contract_from_metadata_layout(contract):
    acc = contract.dimension("dim_account")
    assert acc.columns()[:2] == ["account_key", "c_name"]
    assert acc.tracked_never_null  # the tracked field has a notNull rule
    assert contract.facts[0].foreign_keys == (
        ("nation_id", "dim_nation", "c_nationkey", "c_nationkey"),
        ("segment_id", "dim_segment", "c_mktsegment", "c_mktsegment"))


def test_incremental_late_batch_and_restart(spark, tmpdir_path, contract):
    inp = f"{tmpdir_path}/input"
    os.makedirs(inp)
    for y in (1995, 1996):
        write_batch(spark, inp, y)
    p = Pipeline(spark, contract, inp, f"{tmpdir_path}/out")
    p.run("run-1", dt.datetime(2025, 1, 1))
    acc = contract.dimension("dim_account")
    assert table_rows(p.dimension("dim_account")) == table_rows(expected_dim(p, acc, "run-1"))

    write_batch(spark, inp, 1998)
    out = p.run("run-2", dt.datetime(2025, 1, 2))
    assert out["dimensions"]["dim_account"]["pending"] == ["1998-01-01"]
    assert not out["dimensions"]["dim_account"]["rebuild"]

    write_batch(spark, inp, 1997)  # late: earlier than the latest applied batch
    out = p.run("run-3", dt.datetime(2025, 1, 3))
    late_keys = p.valid_rows(["1997-01-01"]).select("o_custkey").distinct().count()
    assert out["dimensions"]["dim_account"]["refolded_keys"] == late_keys > 0
    dim = p.dimension("dim_account")
    # versions that the late batch does not concern keep the run that wrote them
    run = ("last_updated_run_id",)
    assert table_rows(dim, run) == table_rows(expected_dim(p, acc, "run-3"), run)
    # the warehouse holds exactly the snapshot's versions (no stale current rows)
    wh = p.table("dim_account")
    assert table_rows(wh, drop=("account_id", "updated_at")) == table_rows(dim)
    assert wh.select("account_id").distinct().count() == wh.count()
    fact = p.table("fact_account")
    assert fact.count() == wh.count()
    # a rebuild restamps; the facts of one load carry its time
    assert {r["loaded_at"] for r in fact.collect()} <= {dt.datetime(2025, 1, d) for d in (1, 2, 3)}
    assert {r["violations"] for r in sinks.read_snapshot(spark, f"{tmpdir_path}/out/violations/fact_account").collect()} == {0}
    assert out["dq"]["reconciliation_difference"] == 0
    assert out["dq"]["batch_count"] == 4 and sum(out["dq"]["per_batch_invalid"].values()) == out["dq"]["invalid_records"]
    assert round(out["dq"]["valid_rate"] + out["dq"]["invalid_rate"], 2) == 100.0
    assert sum(sum(c.values()) for c in out["dq"]["invalid_error_breakdown"].values()) >= out["dq"]["invalid_records"]
    assert all(r["completed_at"] > r["started_at"] for r in p.control("etl_runs").collect())
    assert out["dq"]["invalid_records"] > 0
    runs = {r["run_id"]: r["status"] for r in p.control("etl_runs").collect()}
    assert runs == {"run-1": "success", "run-2": "success", "run-3": "success"}

    # restart: a crash between the snapshot and the fact; the next run completes
    def crash(stage):
        if stage == "after_snapshot:dim_account":
            raise RuntimeError("simulated executor loss")

    q = Pipeline(spark, contract, inp, f"{tmpdir_path}/out2", fault=crash)
    with pytest.raises(RuntimeError):
        q.run("run-a", dt.datetime(2025, 2, 1))
    assert {r["status"] for r in q.control("etl_runs").collect()} == {"failed"}
    q.fault = lambda stage: None
    q.run("run-b", dt.datetime(2025, 2, 2))
    # the snapshot published before the crash is kept (rolled forward, not re-applied)
    assert table_rows(q.dimension("dim_account")) == table_rows(expected_dim(q, acc, "run-a"))
    assert q.table("fact_account").count() == q.table("dim_account").count()
    # the dimensions that did not crash were applied by run-a and loaded once
    nat = q.table("dim_nation")
    assert nat.count() == nat.select("c_nationkey").distinct().count()


def test_cli_runs_the_pipeline(spark, tmpdir_path):
    import json as _json
    from dimwright import cli
    inp = f"{tmpdir_path}/input"
    os.makedirs(inp)
    write_batch(spark, inp, 1995)
    path = f"{tmpdir_path}/contract.json"
    with open(path, "w") as fh:
        _json.dump(META, fh)
    out = cli.main(["ingest", "--contract", path, "--input", inp, "--root", f"{tmpdir_path}/out",
                    "--run-id", "cli-1"])
    assert out["pending"] == ["1995-01-01"]
    out = cli.main(["dimensions", "--contract", path, "--input", inp, "--root", f"{tmpdir_path}/out",
                    "--run-id", "cli-1"])
    assert out["dim_account"]["status"] == "success"


def test_contract_version_change_replays_all_batches(spark, tmpdir_path):
    inp = f"{tmpdir_path}/input"
    os.makedirs(inp)
    for y in (1995, 1996):
        write_batch(spark, inp, y)
    p = Pipeline(spark, contract_from_dict(META), inp, f"{tmpdir_path}/out")
    p.run("v1", dt.datetime(2025, 1, 1))
    meta2 = {**META, "dimension_defaults": {**META["dimension_defaults"], "contract_version": "2.0"}}
    p2 = Pipeline(spark, contract_from_dict(meta2), inp, f"{tmpdir_path}/out")
    out = p2.run_dimensions("v2", dt.datetime(2025, 1, 2))
    assert out["dim_account"]["rebuild"] and out["dim_account"]["pending"] == ["1995-01-01", "1996-01-01"]
    versions = {r["contract_version"] for r in p2.control("etl_scd_batches").collect()}
    assert versions == {"2.0"}
    # nothing pending any more for the new version
    again = p2.run_dimensions("v3", dt.datetime(2025, 1, 3))
    assert again["dim_account"]["status"] == "skipped"


def test_rerun_without_new_batches_changes_nothing(spark, tmpdir_path):
    inp = f"{tmpdir_path}/input"
    os.makedirs(inp)
    write_batch(spark, inp, 1995)
    p = Pipeline(spark, contract_from_dict(META), inp, f"{tmpdir_path}/out")
    p.run("r1", dt.datetime(2025, 1, 1))
    before = {n: table_rows(p.table(n)) for n in ("dim_account", "dim_nation", "dim_segment",
                                                  "fact_account", "dim_date")}
    snap = table_rows(p.dimension("dim_account"))
    out = p.run("r2", dt.datetime(2025, 1, 2))
    assert out["ingestion"]["pending"] == []
    assert all(v["status"] == "skipped" for v in out["dimensions"].values())
    assert table_rows(p.dimension("dim_account")) == snap
    assert {n: table_rows(p.table(n)) for n in before} == before


def test_two_new_batches_in_one_run(spark, tmpdir_path, contract):
    """Type-1 and insert-only dimensions take several pending batches as one by one."""
    for name, groups in (("one", [[1995], [1996], [1997], [1998]]), ("many", [[1995], [1996, 1997], [1998]])):
        inp = f"{tmpdir_path}/{name}-input"
        os.makedirs(inp)
        p = Pipeline(spark, contract, inp, f"{tmpdir_path}/{name}")
        for i, years in enumerate(groups):
            for y in years:
                write_batch(spark, inp, y)
            run, now = f"run-{max(years)}", dt.datetime(2025, 1, 1 + i)
            if name == "many":
                p.run(run, now)
            else:  # the snapshots are all that is compared
                p.run_ingestion(run, now)
                p.run_dimensions(run, now)
    one, many = (Pipeline(spark, contract, "", f"{tmpdir_path}/{n}") for n in ("one", "many"))
    for d in contract.dimensions:
        drop = ("last_updated_run_id", "processed_run_id", "ingestion_dt")
        assert table_rows(many.dimension(d.name), drop) == table_rows(one.dimension(d.name), drop), d.name


def test_lost_rows_show_in_the_reconciliation(spark, tmpdir_path, contract):
    import glob

    import pyarrow.parquet as pq

    inp = f"{tmpdir_path}/input"
    os.makedirs(inp)
    write_batch(spark, inp, 1995)
    p = Pipeline(spark, contract, inp, f"{tmpdir_path}/out")
    p.run_ingestion("r", dt.datetime(2025, 1, 1))
    n = spark.read.json(f"{inp}/batch-1995-01-01").count()
    assert p.control("etl_ingestion_batches").first()["input_record_count"] == n
    feed = spark.read.parquet(f"{tmpdir_path}/out/feed")
    assert feed.count() == n
    part = sorted(glob.glob(f"{tmpdir_path}/out/feed/source_batch_date=*/ingest_part=*/*.parquet"))[0]
    rows = pq.ParquetFile(part).read()
    os.remove(os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc"))
    pq.write_table(rows.slice(3), part, use_deprecated_int96_timestamps=True)  # three rows go missing behind the job's back
    spark.catalog.refreshByPath(f"{tmpdir_path}/out/feed")
    p.run_dimensions("r", dt.datetime(2025, 1, 1))
    p.run_warehouse("r", dt.datetime(2025, 1, 1))
    assert p.run_dq("r", dt.datetime(2025, 1, 1))["reconciliation_difference"] == 3


def test_missing_snapshot_raises(spark, tmpdir_path, contract):
    inp = f"{tmpdir_path}/input"
    os.makedirs(inp)
    write_batch(spark, inp, 1995)
    p = Pipeline(spark, contract, inp, f"{tmpdir_path}/out")
    p.run_ingestion("r", dt.datetime(2025, 1, 1))
    p.run_dimensions("r", dt.datetime(2025, 1, 1))
    os.remove(f"{tmpdir_path}/out/dims/dim_account/_CURRENT")
    write_batch(spark, inp, 1996)
    p.run_ingestion("s", dt.datetime(2025, 1, 2))
    with pytest.raises(PipelineError, match="no snapshot"):
        p.run_dimensions("s", dt.datetime(2025, 1, 2))


def stored_files(root):
    """Path -> (bytes, time written) of every data file below ``root``."""
    out = {}
    for d, _, names in os.walk(root):
        for n in names:
            if n.startswith("part-"):
                path = os.path.join(d, n)
                with open(path, "rb") as fh:
                    out[path] = (fh.read(), os.stat(path).st_mtime_ns)
    return out


def parts_of(files, column):
    return {d.split("=")[1] for f in files for d in f.split("/") if d.startswith(f"{column}=")}


def test_a_load_replaces_only_the_parts_it_touches(spark, tmpdir_path, contract):
    """A batch with some 1 % of the keys rewrites their buckets and its own date; every other file stays byte for byte."""
    inp, out = f"{tmpdir_path}/input", f"{tmpdir_path}/out"
    os.makedirs(inp)
    for y in (1995, 1996):
        write_batch(spark, inp, y)
    p = Pipeline(spark, contract, inp, out, bucket_records=10, max_buckets=40)
    p.run("first", dt.datetime(2025, 1, 1))
    assert sinks.snapshot_meta(spark, f"{out}/dims/dim_account")["buckets"] == 40
    tables = {t: f"{out}/{t}" for t in ("dims/dim_account", "warehouse/dim_account", "warehouse/fact_account")}
    before = {t: stored_files(path) for t, path in tables.items()}
    facts = {r["account_id"]: r["loaded_at"] for r in p.table("fact_account").collect()}

    write_batch(spark, inp, 1997)
    few = spark.read.json(f"{inp}/batch-1997-01-01").where("o_custkey in (1, 2, 4)")
    assert few.count() > 0
    few.checkpoint().coalesce(1).write.mode("overwrite").json(f"{inp}/batch-1997-01-01")
    p.run("second", dt.datetime(2025, 1, 2))
    acc = contract.dimension("dim_account")
    valid = p.valid_rows(["1997-01-01"])
    touched = {str(r[0]) for r in valid.select(keys.bucket_of("o_custkey", 40)).distinct().collect()}
    assert 0 < len(touched) <= 3
    for t, path in tables.items():
        after = stored_files(path)
        assert before[t].items() <= after.items(), t  # nothing that was there changed or went
        column, want = ("date_id", {"19970101"}) if "fact" in t else ("key_bucket", touched)
        assert parts_of(set(after) - set(before[t]), column) == want, t
    # the result is that of folding everything at once
    drop = ("last_updated_run_id",)
    assert table_rows(p.dimension("dim_account"), drop) == table_rows(expected_dim(p, acc, "x"), drop)
    wh = p.table("dim_account")
    assert table_rows(wh, ("account_id", "updated_at")) == table_rows(p.dimension("dim_account"))
    assert wh.select("account_id").distinct().count() == wh.count() == p.table("fact_account").count()
    now = {r["account_id"]: r["loaded_at"] for r in p.table("fact_account").collect()}
    assert facts.items() <= now.items() and {now[k] for k in set(now) - set(facts)} == {dt.datetime(2025, 1, 2)}
    assert {r["d"] for r in p.table("fact_account", ["19970101"]).selectExpr("date_id as d").distinct().collect()} == {19970101}


def test_a_late_batch_refolds_its_keys_only(spark, tmpdir_path, contract):
    """Few keys arrive late: their buckets are written anew, and the facts of the dates their versions lie in."""
    inp, out = f"{tmpdir_path}/input", f"{tmpdir_path}/out"
    os.makedirs(inp)
    for y in (1995, 1996, 1998):
        write_batch(spark, inp, y)
    p = Pipeline(spark, contract, inp, out, bucket_records=10, max_buckets=40)
    p.run("first", dt.datetime(2025, 1, 1))
    given = {(r["account_key"], r["start_date"]): r["account_id"] for r in p.table("dim_account").collect()}
    before = {t: stored_files(f"{out}/{t}") for t in ("dims/dim_account", "warehouse/dim_account", "warehouse/fact_account")}
    write_batch(spark, inp, 1997)
    few = spark.read.json(f"{inp}/batch-1997-01-01").where("o_custkey in (1, 2, 4)").checkpoint()
    few.coalesce(1).write.mode("overwrite").json(f"{inp}/batch-1997-01-01")
    report = p.run("late", dt.datetime(2025, 1, 2))["dimensions"]["dim_account"]
    held = [r[0] for r in p.valid_rows(["1997-01-01"]).select("o_custkey").distinct().collect()]
    assert report["refolded_keys"] == len(held) > 0 and not report["rebuild"]
    opened = {d.strftime("%Y%m%d") for k, d in given if k in held}  # dates of versions that were there, some of them gone now
    touched = {str(r[0]) for r in p.valid_rows(["1997-01-01"]).select(keys.bucket_of("o_custkey", 40)).distinct().collect()}
    acc = contract.dimension("dim_account")
    drop = ("last_updated_run_id",)
    dim = p.dimension("dim_account")
    assert table_rows(dim, drop) == table_rows(expected_dim(p, acc, "x"), drop)
    assert {r[0] for r in dim.where("last_updated_run_id = 'late'").select("account_key").distinct().collect()} == set(held)
    assert table_rows(p.table("dim_account"), ("account_id", "updated_at")) == table_rows(dim)
    now = {(r["account_key"], r["start_date"]): r["account_id"] for r in p.table("dim_account").collect()}
    assert all(now[k] == given[k] for k in set(now) & set(given)) and len(set(now.values())) == len(now)
    assert not {now[k] for k in set(now) - set(given)} & set(given.values())
    dates = {r[0].strftime("%Y%m%d") for r in dim.where(F.col("account_key").isin(held)).select("source_batch_date").distinct().collect()}
    for t, column, want in (("dims/dim_account", "key_bucket", touched), ("warehouse/dim_account", "key_bucket", touched),
                            ("warehouse/fact_account", "date_id", dates | opened | {"19970101"})):
        after = stored_files(f"{out}/{t}")
        assert before[t].items() <= after.items() and parts_of(set(after) - set(before[t]), column) <= want, t
    facts = {r["account_id"]: (r["date_id"], r["order_amount"]) for r in p.table("fact_account").collect()}
    versions = {r["account_id"]: (int(r["source_batch_date"].strftime("%Y%m%d")), r["o_totalprice"], r["account_key"]) for r in p.table("dim_account").collect()}
    assert set(facts) == set(versions)
    assert all(facts[i] == v[:2] for i, v in versions.items() if v[2] in held)
    # a second load finds nothing due
    p.run("again", dt.datetime(2025, 1, 3))
    assert stored_files(f"{out}/warehouse/fact_account") == after


def test_a_new_contract_version_writes_every_part_and_reuses_no_key(spark, tmpdir_path, contract):
    inp, out = f"{tmpdir_path}/input", f"{tmpdir_path}/out"
    os.makedirs(inp)
    for y in (1995, 1996):
        write_batch(spark, inp, y)
    p = Pipeline(spark, contract, inp, out, bucket_records=100, max_buckets=5)
    p.run("first", dt.datetime(2025, 1, 1))
    given = {(r["account_key"], r["start_date"]): r["account_id"] for r in p.table("dim_account").collect()}
    meta2 = {**META, "dimension_defaults": {**META["dimension_defaults"], "contract_version": "2.0"}}
    q = Pipeline(spark, contract_from_dict(meta2), inp, out, bucket_records=10, max_buckets=8)  # other buckets as well
    q.run("second", dt.datetime(2025, 1, 2))
    assert table_rows(q.dimension("dim_account")) == table_rows(expected_dim(q, contract.dimension("dim_account"), "second"))
    assert {(r["account_key"], r["start_date"]): r["account_id"] for r in q.table("dim_account").collect()} == given
    assert sinks.snapshot_meta(spark, f"{out}/warehouse/dim_account")["buckets"] == 8
    assert {r["loaded_at"] for r in q.table("fact_account").collect()} == {dt.datetime(2025, 1, 2)}
    assert q.table("fact_account").count() == len(given)


def test_tables_stored_as_a_whole_are_taken_over(spark, tmpdir_path, contract):
    """Dimensions and facts in one versioned directory, as earlier versions wrote them."""
    inp, out = f"{tmpdir_path}/input", f"{tmpdir_path}/out"
    os.makedirs(inp)
    write_batch(spark, inp, 1995)
    p = Pipeline(spark, contract, inp, out)
    p.run("first", dt.datetime(2025, 1, 1))
    for kind, name in (("dims", "dim_account"), ("warehouse", "dim_account"), ("warehouse", "fact_account")):
        rows = (p.dimension if kind == "dims" else p.table)(name).checkpoint()
        meta = sinks.snapshot_meta(spark, f"{out}/{kind}/{name}")
        os.remove(f"{out}/{kind}/{name}/_CURRENT")
        sinks.write_snapshot(rows, f"{out}/{kind}/{name}", meta={k: meta[k] for k in ("batches", "run_id", "contract_version", "rebuild") if k in meta})
    write_batch(spark, inp, 1996)
    p.run("second", dt.datetime(2025, 1, 2))
    acc = contract.dimension("dim_account")
    drop = ("last_updated_run_id",)
    assert table_rows(p.dimension("dim_account"), drop) == table_rows(expected_dim(p, acc, "x"), drop)
    assert p.table("fact_account").count() == p.table("dim_account").count() == p.dimension("dim_account").count()
    assert {r["d"] for r in p.table("fact_account").selectExpr("date_id as d").distinct().collect()} == {19950101, 19960101}


def test_metrics_read_the_feed_of_new_batches_only(spark, tmpdir_path, contract):
    """The metrics of a run come from the ledger; the feed is read for batches that the ledger does not know yet."""
    import shutil
    inp, out = f"{tmpdir_path}/input", f"{tmpdir_path}/out"
    os.makedirs(inp)
    p = Pipeline(spark, contract, inp, out)
    for run, year in (("r1", 1995), ("r2", 1996)):
        write_batch(spark, inp, year)
        p.run_ingestion(run, dt.datetime(2025, 1, 1))
        got = p.run_dq(run, dt.datetime(2025, 1, 1))
    feed = spark.read.parquet(f"{out}/feed")
    keyed = feed.where("record_status = 'valid'")
    valid, keys_ = keyed.count(), keyed.select("o_custkey").distinct().count()
    assert got["valid_records"] == valid and got["valid_duplicate_rate"] == round(100 * (valid - keys_) / valid + 1e-9, 2)
    codes = {f: dict(c) for f, c in got["invalid_error_breakdown"].items()}
    want = {}
    for r in dq.error_breakdown(feed.where("record_status = 'invalid'")).collect():
        want.setdefault(r["field"], {})[r["code"]] = r["error_count"]
    assert codes == want
    before = stored_files(f"{out}/ledger/keys")
    # the first batch's feed is out of reach: a run for a third batch does not miss it
    shutil.move(f"{out}/feed/source_batch_date=1995-01-01", f"{tmpdir_path}/away")
    write_batch(spark, inp, 1997)
    p.run_ingestion("r3", dt.datetime(2025, 1, 1))
    third = p.run_dq("r3", dt.datetime(2025, 1, 1))
    assert third["reconciliation_difference"] == 0 and third["batch_count"] == 3
    assert third["valid_records"] == valid + spark.read.parquet(f"{out}/feed/source_batch_date=1997-01-01").where("record_status = 'valid'").count()
    after = stored_files(f"{out}/ledger/keys")
    assert before.items() <= after.items() and parts_of(set(after) - set(before), "source_batch_date") == {"1997-01-01"}


def test_bad_input_is_refused_and_taken_once_mended(spark, tmpdir_path, contract):
    inp = f"{tmpdir_path}/input"
    os.makedirs(f"{inp}/batch-1995-01-01")
    p = Pipeline(spark, contract, inp, f"{tmpdir_path}/out")
    bad = f"{inp}/batch-1995-01-01/part-0.json"
    open(bad, "w").close()
    with pytest.raises(PipelineError, match="empty input"):
        p.run("r1", dt.datetime(2025, 1, 1))
    with open(bad, "w") as fh:
        fh.write("not json\nneither\n")
    with pytest.raises(PipelineError, match="can be read"):
        p.run("r2", dt.datetime(2025, 1, 1))
    assert p.control("etl_ingestion_batches").count() == 0
    write_batch(spark, inp, 1995)
    out = p.run("r3", dt.datetime(2025, 1, 2))
    assert out["ingestion"]["pending"] == ["1995-01-01"] and out["dq"]["reconciliation_difference"] == 0
    runs = {r["run_id"]: (r["status"], r["violations"]) for r in p.control("etl_runs").collect()}
    assert runs == {"r1": ("failed", None), "r2": ("failed", None), "r3": ("success", 0)}


def test_violations_in_the_tables_are_counted(spark, tmpdir_path, contract):
    inp, out = f"{tmpdir_path}/input", f"{tmpdir_path}/out"
    os.makedirs(inp)
    write_batch(spark, inp, 1995)
    p = Pipeline(spark, contract, inp, out)
    p.run("r", dt.datetime(2025, 1, 1))
    spec = contract.dimension("dim_account")
    root = f"{out}/warehouse/dim_account"
    rows = sinks.read_parts(spark, root)
    worse = rows.withColumns({"is_current": F.col("is_current") & (F.col("account_id") % 5 != 0),
                              "c_name": F.when(F.col("account_id") % 7 != 0, F.col("c_name"))}).checkpoint()
    meta = sinks.snapshot_meta(spark, root)
    sinks.write_parts(worse, root, "key_bucket", meta={k: meta[k] for k in ("buckets", "max_key")})
    found = p.check_tables({"dim_account": ["1995-01-01"]})
    assert found["dim_account: one_current"] == worse.where("account_id % 5 = 0").count() > 0
    assert found["dim_account: snapshot"] == worse.where("account_id % 5 = 0 or account_id % 7 = 0").count()
    assert sinks.read_snapshot(spark, f"{out}/violations/dim_account-one_current").count() == found["dim_account: one_current"]
    assert spec.is_scd2 and found["dim_account: gapless"] == 0


def test_kept_marts_equal_marts_over_the_whole_star(spark, tmpdir_path, contract):
    """Batches in order, a crash between pairs and groups, a late batch: the kept mart is that of the stored tables each time."""
    inp, out = f"{tmpdir_path}/input", f"{tmpdir_path}/out"
    os.makedirs(inp)
    open_by_segment = marts.MartSpec(name="open", fact="fact_account", entity="account_key", measure="order_amount",
                                     groups=(("segment_id", "segment_id"), ("tier", "c_mktsegment")), where="is_current AND o_orderstatus = 'O'")
    by_month = marts.MartSpec(name="month", fact="fact_account", entity="account_key", measure="order_amount",
                              groups=(("month_id", "date_id div 100"), ("nation_id", "nation_id")))

    def check(p):
        joined = p.table("fact_account").join(p.table("dim_account").drop("updated_at"), "account_id")
        for spec in p.marts:
            want = joined.where(spec.where).groupBy(*[F.expr(e).alias(n) for n, e in spec.groups]).agg(
                F.count_distinct("account_key").alias("entity_count"), F.count("*").alias("row_count"),
                F.round(F.sum(F.col("order_amount").cast("decimal(20,2)")), 2).cast("double").alias("total_amount"))
            got = p.mart(spec.name).drop("avg_amount")
            assert table_rows(got) == table_rows(want) != [], spec.name

    def pipeline(fault=lambda stage: None):
        return Pipeline(spark, contract, inp, out, bucket_records=10, max_buckets=8, marts=(open_by_segment, by_month), fault=fault)

    for y in (1995, 1996):
        write_batch(spark, inp, y)
    p = pipeline()
    assert p.mart("open") is None
    p.run("first", dt.datetime(2025, 1, 1))
    check(p)
    write_batch(spark, inp, 1997)
    few = spark.read.json(f"{inp}/batch-1997-01-01").where("o_custkey in (1, 2, 4)")
    few.checkpoint().coalesce(1).write.mode("overwrite").json(f"{inp}/batch-1997-01-01")
    pairs = f"{out}/marts/month/pairs"
    before = stored_files(pairs)
    p.run("second", dt.datetime(2025, 1, 2))
    touched = {str(r[0]) for r in p.valid_rows(["1997-01-01"]).select(keys.bucket_of("o_custkey", 8)).distinct().collect()}
    after = stored_files(pairs)
    assert before.items() <= after.items() and parts_of(set(after) - set(before), "key_bucket") == touched
    assert 0 < len(touched) <= 3
    check(p)

    # groups that follow other pairs are summed from the pairs
    stale = f"{out}/marts/month/groups"
    sinks.write_snapshot(sinks.read_snapshot(spark, stale).limit(1), stale, meta={"number": -1})
    write_batch(spark, inp, 1999)
    p.run("third", dt.datetime(2025, 1, 3))
    check(p)

    def crash(stage):
        if stage == "after_pairs:month":
            raise RuntimeError("simulated executor loss")

    write_batch(spark, inp, 1998)
    with pytest.raises(RuntimeError, match="simulated"):
        pipeline(crash).run("late", dt.datetime(2025, 1, 4))
    p = pipeline()
    p.run("again", dt.datetime(2025, 1, 5))
    check(p)
    with pytest.raises(PipelineError, match="business key"):
        Pipeline(spark, contract, inp, out, marts=(marts.MartSpec(name="bad", fact="fact_account", entity="c_nationkey",
                                                                  measure="order_amount", groups=()),))
