"""Ingestion operators: lineage stamps, batch discovery over paths, pending scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.operators.plan_utils import sized_broadcast

BATCH_PATTERN = r"batch-(\d{4}-\d{2}-\d{2})"


def _lit_or(c: str | Column, cast: str | None = None) -> Column:
    col = c if isinstance(c, Column) else F.lit(c)
    return col.cast(cast) if cast else col


def stamp_lineage(df: DataFrame, batch_date: str | Column, run_id: str | Column,
                  ingestion_ts: Column | None = None) -> DataFrame:
    """Add ``source_batch_date``, ``processed_run_id`` (and ``ingestion_dt``)."""
    cols = {"source_batch_date": _lit_or(batch_date, "date"),
            "processed_run_id": _lit_or(run_id, "string")}
    if ingestion_ts is not None:
        cols["ingestion_dt"] = ingestion_ts
    return df.withColumns(cols)


def batch_dates_from_paths(paths: DataFrame, path_col: str) -> DataFrame:
    """Distinct valid batch dates named by ``batch-YYYY-MM-DD`` path segments, sorted."""
    raw = F.regexp_extract(F.col(path_col), BATCH_PATTERN, 1)
    d = F.try_to_timestamp(F.when(raw != "", raw), F.lit("yyyy-MM-dd")).cast("date")
    return (paths.select(d.alias("batch_date")).where(F.col("batch_date").isNotNull())
            .distinct().orderBy("batch_date"))


def pending_batches(available: DataFrame, completed: DataFrame, col: str = "batch_date") -> DataFrame:
    """available - completed (dates normalised), distinct, sorted."""
    a = available.select(F.col(col).cast("date").alias(col)).distinct()
    c = completed.select(F.col(col).cast("date").alias(col)).distinct()
    return a.join(c, col, "left_anti").orderBy(col)


def pending_scan(rows: DataFrame, pending: DataFrame, batch_col: str = "source_batch_date",
                 pending_col: str = "batch_date") -> DataFrame:
    """Rows of pending batches only.

    The pending list has one row per batch (bounded by the number of batches),
    so it is broadcast; on a table partitioned by the batch column the semi
    join also prunes partitions (dynamic partition pruning).
    """
    p = sized_broadcast(pending.select(F.col(pending_col).cast("date").alias("__pb")).distinct())
    return rows.join(p, F.col(batch_col).cast("date") == F.col("__pb"), "left_semi")
