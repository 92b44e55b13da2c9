import os

import pytest

from pyspark.sql import functions as F

from dimwright.sources import paths, sinks


def test_discover_batch_dates_ignores_malformed(spark, tmpdir_path):
    for name in ("batch-2025-02-15", "batch-2025-01-15", "batch-2025-13-01", "tmp", "batch-x"):
        os.makedirs(f"{tmpdir_path}/{name}")
    assert paths.discover_batch_dates(spark, tmpdir_path) == ["2025-01-15", "2025-02-15"]
    assert paths.discover_batch_dates(spark, f"{tmpdir_path}/missing") == []


def test_path_exists_and_split_uri(spark, tmpdir_path):
    open(f"{tmpdir_path}/input-1.jsonl", "w").close()
    assert paths.path_exists(spark, f"{tmpdir_path}/input*.jsonl")
    assert not paths.path_exists(spark, f"{tmpdir_path}/nothing*.jsonl")
    assert paths.split_uri("s3a://order-drops/batch-2025-01-15/input.jsonl") == (
        "order-drops", "batch-2025-01-15/input.jsonl")
    with pytest.raises(ValueError):
        paths.split_uri("/no/scheme")


def test_snapshots_are_versioned(spark, tmpdir_path):
    root = f"{tmpdir_path}/snap"
    assert sinks.read_snapshot(spark, root) is None
    v1 = sinks.write_snapshot(spark.range(3), root, meta={"batches": ["2025-01-15"]})
    v2 = sinks.write_snapshot(sinks.read_snapshot(spark, root).where("id > 0"), root)
    assert v1 != v2 and sinks.read_snapshot(spark, root).count() == 2
    assert spark.read.parquet(v1).count() == 3  # the version a plan read is never overwritten
    assert sinks.snapshot_meta(spark, root)["path"] == v2


def test_latest_row_without_sort(spark):
    import datetime as dt
    from dimwright.operators import state
    runs = spark.createDataFrame([("r1", dt.datetime(2025, 1, 1), 0), ("r3", dt.datetime(2025, 3, 1), 1),
                                  ("r2", dt.datetime(2025, 2, 1), 0)],
                                 "run_id string, measured_at timestamp, difference long")
    assert state.latest_row(runs, ["measured_at"]).first()["run_id"] == "r3"
    assert state.latest_row(runs.limit(0), ["measured_at"]).count() == 0


def test_parts_are_replaced_one_by_one(spark, tmpdir_path):
    root = f"{tmpdir_path}/t"
    rows = spark.range(100).select(F.col("id"), (F.col("id") % 4).cast("int").alias("b"))
    assert sinks.read_parts(spark, root) is None
    got = sinks.write_parts(rows, root, "b", observe={"most": F.max("id")}, meta={"x": 1})
    assert got == {"most": 99} and sinks.snapshot_meta(spark, root)["x"] == 1
    assert sinks.read_parts(spark, root).columns == ["id", "b"] and sinks.read_parts(spark, root).count() == 100
    old = sinks.read_parts(spark, root)
    # part 1 gets other rows, part 2 none
    sinks.write_parts(rows.where("b = 1").limit(3), root, "b", ["1", "2"])
    count = {r["b"]: r["count"] for r in sinks.read_parts(spark, root).groupBy("b").count().collect()}
    assert count == {0: 25, 1: 3, 3: 25}
    assert old.count() == 100  # a plan made before still reads what it saw
    assert sinks.read_parts(spark, root, ["1", "2"]).count() == 3 and sinks.read_parts(spark, root, ["2"]).count() == 0
    assert sinks.read_parts(spark, root, ["2"]).schema == old.schema
    # nothing is published if rows lie outside of the parts named, or have another schema
    before = sinks.snapshot_meta(spark, root)
    with pytest.raises(ValueError, match="outside"):
        sinks.write_parts(rows, root, "b", ["1"])
    with pytest.raises(ValueError, match="schema"):
        sinks.write_parts(rows.withColumn("c", F.lit(1)), root, "b", ["1"])
    assert sinks.snapshot_meta(spark, root) == before
    # a part keeps its last few directories
    for i in range(6):
        sinks.write_parts(rows.where("b = 0").limit(i + 1), root, "b", ["0"])
    assert len(sinks.snapshot_meta(spark, root)["parts"]["0"]) == sinks.KEPT_VERSIONS
    published = sinks.snapshot_meta(spark, root)["parts"]["0"]
    assert {f"written={v}" for v in published} <= set(os.listdir(f"{root}/b=0"))
    assert sinks.read_parts(spark, root, ["0"]).count() == 6
    # no rows at all: an empty table with its schema
    sinks.write_parts(rows.limit(0), root, "b")
    assert sinks.read_parts(spark, root).count() == 0
