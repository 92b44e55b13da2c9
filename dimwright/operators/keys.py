"""Surrogate keys and merges (upsert / insert-missing) on natural keys.

Dense surrogate keys without a global window: the rows are materialised once
(reliable checkpoint: every row's place becomes fixed) and only their natural key
and place are range-partitioned, sorted and materialised again.  A row's index
inside its range comes from ``monotonically_increasing_id`` (partition id << 33 |
index), the counts of the ranges, one row each, are summed up before it, and the
numbers go back to the rows by their place, broadcast if they are counted as few.
The wide rows are not sorted, and every stage stays parallel.

The second checkpoint must come after the range exchange: the range partitioner
seeds its bound sampling with the RDD id, so two evaluations of an un-materialised
range exchange may cut different ranges.  The first comes before it, because that
sampling is a job of its own that would otherwise run the whole upstream plan again.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimwright.operators.plan_utils import sized_broadcast
from dimwright.session import ensure_checkpoint_dir

_LOW33 = (1 << 33) - 1
#: numbers (two longs each) go back to their rows by a broadcast up to this many
BROADCAST_NUMBERS = 1_000_000


def bucket_of(business_key: str, buckets: int) -> Column:
    """Bucket of a business key, whatever its type: equal keys share one, NULL keys too."""
    return F.pmod(F.xxhash64(F.col(f"`{business_key}`").cast("string")), F.lit(buckets)).cast("int")


def assign_surrogate_keys(df: DataFrame, nk: Sequence[str], key_col: str,
                          base: Column | int = 0, partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` = base + 1, 2, ... in natural-key order (dense, deterministic; equal keys in the order of their places)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cols = [F.col(f"`{c}`") for c in nk]
    fixed = df.checkpoint(eager=True).withColumn("__row", F.monotonically_increasing_id())
    narrow = fixed.select(*cols, "__row")
    # without an explicit count AQE may coalesce small ranges; the checkpoint fixes whatever layout results
    ranged = narrow.repartitionByRange(partitions, *cols) if partitions else narrow.repartitionByRange(*cols)
    tagged = ranged.sortWithinPartitions(*cols, "__row").checkpoint(eager=True).select(
        "__row", F.spark_partition_id().alias("__pid"), F.monotonically_increasing_id().alias("__mid"))
    counts = {r["__pid"]: r["n"] for r in tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per range
    offsets, total = [], 0
    for pid in sorted(counts):
        offsets.append((pid, total))
        total += counts[pid]
    before = F.broadcast(spark.createDataFrame(offsets, "__pid int, __off long"))
    base_col = base if isinstance(base, Column) else F.lit(int(base))
    number = base_col.cast("long") + F.col("__off") + F.col("__mid").bitwiseAND(F.lit(_LOW33)) + 1
    numbers = tagged.join(before, "__pid").select("__row", number.alias("__number"))
    if total <= BROADCAST_NUMBERS:
        numbers = F.broadcast(numbers)
    return fixed.join(numbers, "__row").select(*[F.col(f"`{c}`") for c in df.columns], F.col("__number").alias(key_col))


def max_key(target: DataFrame, key_col: str) -> Column:
    """Scalar subquery: current maximum key (0 for an empty target)."""
    return target.select(F.coalesce(F.max(key_col), F.lit(0)).cast("long")).scalar()


def merge_upsert(target: DataFrame, staging: DataFrame, nk: Sequence[str], key_col: str,
                 audit: dict[str, Column] | None = None, base: int | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT (nk) DO UPDATE.

    ``base`` is the highest key given so far, if known (``target`` may be a part of a table); else it is read.

    NULL key parts match each other, so a repeated load adds no second row.
    Matched rows take the staging values and keep the target's surrogate key;
    new rows get ``max(key) + dense offset``; untouched target rows pass through.
    ``audit`` columns (e.g. ``updated_at``) are stamped on inserted/updated rows.
    The new rows come from an anti join against the target's key columns only,
    so the wide target moves at most once (for the left join that applies updates);
    staging is materialised once.
    """
    audit = audit or {}
    nk = list(nk)
    ensure_checkpoint_dir(staging.sparkSession)
    staging = staging.checkpoint(eager=True)  # its plan, say a replay, runs once for the updates and the new rows
    value_cols = [c for c in staging.columns if c not in nk]
    out_cols = list(target.columns)
    s = staging.select(*[F.col(f"`{c}`") for c in nk],
                       *[F.col(f"`{c}`").alias(f"s__{c}") for c in value_cols],
                       F.lit(True).alias("s__present"))
    # a small staging set (the usual incremental load) is broadcast after a
    # size check, so the large target is not shuffled
    same = [F.col(f"t.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in nk]
    kept = target.alias("t").join(sized_broadcast(s).alias("s"), same, "left_outer").select("t.*", *[
        F.col(f"s.`{c}`") for c in s.columns if c not in nk])
    present = F.col("s__present").isNotNull()

    def pick(c: str) -> Column:
        if c in audit:
            return F.when(present, audit[c]).otherwise(F.col(f"`{c}`"))
        if c in value_cols and c != key_col:
            return F.when(present, F.col(f"s__{c}")).otherwise(F.col(f"`{c}`"))
        return F.col(f"`{c}`")

    updated = kept.select(*[pick(c).alias(c) for c in out_cols])
    new_rows = _missing(staging, target, nk)
    staged_new = new_rows.select(*[
        (audit[c] if c in audit else F.col(f"`{c}`") if c in staging.columns
         else F.lit(None).cast(target.schema[c].dataType)).alias(c)
        for c in out_cols if c != key_col])
    inserted = assign_surrogate_keys(staged_new, nk, key_col, base=max_key(target, key_col) if base is None else base)
    return updated.unionByName(inserted.select(*out_cols))


def _missing(staging: DataFrame, target: DataFrame, nk: Sequence[str]) -> DataFrame:
    """Staging rows whose key the target lacks; NULL key parts match each other."""
    keys = target.select(*[F.col(f"`{c}`") for c in nk])
    return staging.alias("s").join(keys.alias("t"), [F.col(f"s.`{c}`").eqNullSafe(F.col(f"t.`{c}`")) for c in nk], "left_anti")


def merge_append_missing(target: DataFrame, staging: DataFrame, nk: Sequence[str]) -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING: append staging rows whose key is absent."""
    missing = _missing(staging, target, nk)
    return target.unionByName(missing.select(*target.columns))
