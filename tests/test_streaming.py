import os

from pyspark.sql import functions as F

from dimwright.contract import contract_from_dict
from dimwright.operators import validate
from dimwright.sources import sinks
from dimwright.streaming.ingest import start_ingestion

from test_job import META, write_batch


def test_available_now_ingestion_is_incremental(spark, tmpdir_path):
    contract = contract_from_dict(META)
    inp, out, ck = (f"{tmpdir_path}/{x}" for x in ("input", "out", "ck"))
    os.makedirs(inp)
    write_batch(spark, inp, 1995)
    q = start_ingestion(spark, contract.feed, inp, out, ck, "stream")
    q.awaitTermination(300)
    first = spark.read.parquet(out).count()
    src = spark.read.json(f"{inp}/batch-1995-01-01")
    assert first == src.count() > 0

    write_batch(spark, inp, 1996)
    q = start_ingestion(spark, contract.feed, inp, out, ck, "stream")
    q.awaitTermination(300)
    feed = spark.read.parquet(out)
    per_batch = {r["source_batch_date"].year: r["n"] for r in
                 feed.groupBy("source_batch_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_batch[1995] == first  # the first batch was not re-read
    assert per_batch[1996] == spark.read.json(f"{inp}/batch-1996-01-01").count()
    invalid = sinks.read_split(spark, out, "invalid")
    assert invalid.count() > 0 and "validation_errors" in invalid.columns


def test_second_file_of_a_batch_is_added(spark, tmpdir_path):
    contract = contract_from_dict(META)
    inp, out, ck = (f"{tmpdir_path}/{x}" for x in ("input", "out", "ck"))
    os.makedirs(inp)
    write_batch(spark, inp, 1995)
    start_ingestion(spark, contract.feed, inp, out, ck, "stream").awaitTermination(300)
    first = spark.read.parquet(out).count()
    extra = spark.read.json(f"{inp}/batch-1995-01-01").limit(3)
    extra.coalesce(1).write.mode("append").json(f"{inp}/batch-1995-01-01")
    start_ingestion(spark, contract.feed, inp, out, ck, "stream").awaitTermination(300)
    assert spark.read.parquet(out).count() == first + 3
    rows = sinks.read_split(spark, out, "valid").count() + sinks.read_split(spark, out, "invalid").count()
    assert rows == first + 3 and "ingest_part" not in sinks.read_split(spark, out, "valid").columns


def test_two_streams_and_the_batch_job_share_a_feed(spark, tmpdir_path):
    """Both number their micro-batches from 0; neither takes the other's rows, nor do they hinder the batch layout."""
    contract = contract_from_dict(META)
    out = f"{tmpdir_path}/out"
    total = 0
    for name, year in (("a", 1995), ("b", 1995), ("c", 1996)):
        inp = f"{tmpdir_path}/{name}"
        os.makedirs(inp)
        write_batch(spark, inp, year)
        total += spark.read.json(f"{inp}/batch-{year}-01-01").count()
    for name in "ab":
        start_ingestion(spark, contract.feed, f"{tmpdir_path}/{name}", out, f"{tmpdir_path}/ck-{name}", "stream").awaitTermination(300)
    # the same input again under a new checkpoint is another stream
    raw = spark.read.schema(contract.feed.schema).json(f"{tmpdir_path}/c/batch-1996-01-01").withColumns({
        "source_batch_date": F.lit("1996-01-01").cast("date"), "processed_run_id": F.lit("job"), "ingestion_dt": F.current_timestamp()})
    sinks.write_split(validate.classify(raw, contract.feed.validations), out, batches=["1996-01-01"])
    feed = spark.read.parquet(out)
    assert feed.count() == total
    assert feed.where("source_batch_date = '1995-01-01'").select("ingest_part").distinct().count() == 2
    rows = [sinks.read_split(spark, out, s) for s in ("valid", "invalid")]
    assert sum(r.count() for r in rows) == total and "ingest_part" not in rows[0].columns


def test_the_batch_job_replaces_what_a_stream_left_of_its_batch(spark, tmpdir_path):
    contract = contract_from_dict(META)
    inp, out = f"{tmpdir_path}/input", f"{tmpdir_path}/out"
    os.makedirs(inp)
    write_batch(spark, inp, 1995)
    start_ingestion(spark, contract.feed, inp, out, f"{tmpdir_path}/ck", "stream").awaitTermination(300)
    rows = spark.read.parquet(out).drop("ingest_part").checkpoint()
    sinks.write_split(rows, out, batches=["1995-01-01"])
    assert spark.read.parquet(out).count() == rows.count()

    def fail(_):
        raise RuntimeError("lost")

    # a write that fails leaves the rows that are there
    bad = rows.withColumn("o_orderstatus", F.udf(fail, "string")("o_orderstatus"))
    try:
        sinks.write_split(bad, out, batches=["1995-01-01"])
    except Exception:  # noqa: BLE001
        pass
    spark.catalog.refreshByPath(out)
    assert spark.read.parquet(out).count() == rows.count()
