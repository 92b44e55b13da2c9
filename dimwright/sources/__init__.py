"""Readers and writers: dated JSONL batches, partitioned Parquet, snapshots."""
