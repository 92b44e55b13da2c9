"""Plan-level helpers: size-checked broadcast, shuffle layout, plan statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def planned_size_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate of ``df`` (file sizes for scans), no action.

    Estimates multiply at joins, so size a side from a table that was read or
    materialised, not from a long plan.  None where there is no local plan to ask
    (a remote session).
    """
    if not hasattr(df, "_jdf"):
        return None
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def counted_broadcast(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast a materialised ``df`` (a table or a checkpoint) if it has at most ``max_rows`` rows.

    For sides whose estimate says nothing (checkpoints after joins): counting
    stops as soon as the limit is passed.  Wide rows count for more: the limit is one
    of rows of up to eight columns.
    """
    most = max_rows if len(df.columns) <= 8 else max_rows * 8 // len(df.columns)
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


#: a row in memory takes about so many times its bytes in compressed column files
MEMORY_FACTOR = 4


def fits_broadcast(df: DataFrame, limit_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether the planned size of ``df``, taken as compressed files, fits ``limit_bytes`` in memory."""
    size = planned_size_bytes(df)
    return size is not None and size * MEMORY_FACTOR <= limit_bytes


def sized_broadcast(df: DataFrame, limit_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its planned size is under ``limit_bytes``.

    Beyond the limit the join stays a shuffle join (AQE can still switch it to
    a broadcast at run time from the real shuffle size).
    """
    return F.broadcast(df) if fits_broadcast(df, limit_bytes) else df


#: compressed column files that make one part of a shuffle, and the parts below which the session lays it out as it likes
PART_BYTES = 4 * 1024 * 1024
FEW_PARTS = 8


def parts_for(source: DataFrame, part_bytes: int = PART_BYTES) -> int | None:
    """Parts to deal out what is made from the table ``source`` into; None for a small one, whose layout is the session's."""
    size = planned_size_bytes(source)
    parts = 0 if size is None else -(-size // part_bytes)
    return parts if parts > FEW_PARTS else None


def spread(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` into ``parts`` (``parts_for`` its table).

    The joins and windows by ``keys`` that follow keep this layout, so what one task
    holds does not grow with the table, whatever number of shuffle partitions the
    session has.
    """
    return df.repartition(parts, *keys) if parts else df
