"""Streaming ingestion: new batch files -> classified, partitioned output.

The file source's checkpoint remembers which files were read, replacing the
"unprocessed ingestion batches" bookkeeping: each trigger picks up only new
files.  ``trigger(availableNow=True)`` drains everything present and stops,
which suits a scheduled batch job; a processing-time trigger turns the same
query into a continuously running ingester.  ``foreachBatch`` applies the
validation split and the idempotent partitioned write of the batch path; each
micro-batch owns a part below its batch, named by the query's id (which its checkpoint
keeps) and the epoch: a retried one replaces itself, a second file of the same
batch is added, and another stream, or one with a new checkpoint, never takes its place.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dimwright.contract import FeedSpec
from dimwright.operators import validate
from dimwright.sources import sinks

BATCH_IN_PATH = r"batch-(\d{4}-\d{2}-\d{2})"


def stream_source(spark: SparkSession, feed: FeedSpec, input_root: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    if feed.schema is None:
        raise ValueError("streaming sources need a declared schema")
    reader = (spark.readStream.format(feed.format).schema(feed.schema)
              .options(**dict(feed.options)).option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    glob = feed.path if feed.path and "{date}" not in feed.path else "*"
    df = reader.load(f"{input_root.rstrip('/')}/batch-*/{glob}")
    batch = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), BATCH_IN_PATH, 1))
    return df.withColumn("source_batch_date", batch)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint for as long as that exists."""
    return json.loads(sinks.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def start_ingestion(spark: SparkSession, feed: FeedSpec, input_root: str, output: str,
                    checkpoint: str, run_id: str, available_now: bool = True,
                    processing_time: str | None = None) -> StreamingQuery:
    """Start the ingestion query; returns the StreamingQuery handle."""
    src = stream_source(spark, feed, input_root)

    def each(batch_df: DataFrame, epoch_id: int) -> None:
        stamped = batch_df.withColumns({
            "processed_run_id": F.lit(f"{run_id}-{epoch_id}"),
            "ingestion_dt": F.current_timestamp(),
        })
        sinks.write_split(validate.classify(stamped, feed.validations), output,
                          part=f"stream-{query_id(batch_df.sparkSession, checkpoint)}-{epoch_id}")

    w = src.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
