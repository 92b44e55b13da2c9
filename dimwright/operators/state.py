"""Control state: which batches are ingested, applied, loaded; run bookkeeping.

Control tables are small (one row per batch and dimension), kept as
DataFrames and merged like any other table.  Decisions that steer the job
(late arrival, contract change) read a one-row aggregate of them.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.operators.plan_utils import sized_broadcast

SCD_CONTROL_COLUMNS = ["batch_date", "dimension_name", "contract_version", "run_id",
                       "first_processed_on", "processed_on", "warehouse_loaded_on"]


def upsert_by_key(target: DataFrame, staging: DataFrame, keys: Sequence[str],
                  keep_first: Sequence[str] = ()) -> DataFrame:
    """Replace rows by key; ``keep_first`` columns keep the existing value."""
    keys = list(keys)
    cols = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    s = staging.select(*[F.col(k).cast(types[k]).alias(k) for k in keys],
                       *[F.col(c).cast(types[c]).alias(f"s__{c}") for c in cols if c not in keys],
                       F.lit(True).alias("s__hit"))
    j = target.join(s, keys, "full_outer")
    hit = F.col("s__hit").isNotNull()
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in keep_first:
            out.append(F.coalesce(F.col(c), F.col(f"s__{c}")).alias(c))
        else:
            out.append(F.when(hit, F.col(f"s__{c}")).otherwise(F.col(c)).alias(c))
    return j.select(*out)


def mark_scd_done(control: DataFrame, batches: DataFrame, dimension: str, run_id: str,
                  contract_version: str, processed_on: Column) -> DataFrame:
    """Upsert (batch, dimension) as applied by ``run_id``; clears the warehouse marker."""
    staging = batches.select(
        F.col("batch_date").cast("date").alias("batch_date"),
        F.lit(dimension).alias("dimension_name"), F.lit(contract_version).alias("contract_version"),
        F.lit(run_id).alias("run_id"), processed_on.alias("first_processed_on"),
        processed_on.alias("processed_on"), F.lit(None).cast("date").alias("warehouse_loaded_on"))
    return upsert_by_key(control, staging, ["batch_date", "dimension_name"],
                         keep_first=["first_processed_on"])


def mark_loaded(control: DataFrame, batches: DataFrame, dimension: str, loaded_on: Column) -> DataFrame:
    b = sized_broadcast(batches.select(F.col("batch_date").cast("date").alias("__b")).distinct())
    hit = control.join(b, F.col("batch_date") == F.col("__b"), "left").withColumn(
        "__hit", F.col("__b").isNotNull() & (F.col("dimension_name") == dimension)).drop("__b")
    return hit.withColumn("warehouse_loaded_on", F.when(F.col("__hit"), loaded_on)
                          .otherwise(F.col("warehouse_loaded_on"))).drop("__hit")


def clear_markers(control: DataFrame, dimension: str) -> DataFrame:
    """Forget warehouse loads of a dimension (rebuild / contract change)."""
    return control.withColumn("warehouse_loaded_on", F.when(F.col("dimension_name") == dimension,
                                                            F.lit(None).cast("date"))
                              .otherwise(F.col("warehouse_loaded_on")))


def completed(control: DataFrame, dimension: str) -> DataFrame:
    return control.where(F.col("dimension_name") == dimension).select("batch_date").distinct()


def pending_star(control: DataFrame, dimension: str) -> DataFrame:
    """Applied batches of a dimension not yet loaded into the warehouse, in order."""
    return (control.where((F.col("dimension_name") == dimension) & F.col("warehouse_loaded_on").isNull())
            .select("batch_date").distinct().orderBy("batch_date"))


def pending_run_ids(control: DataFrame, dimension: str, batches: DataFrame) -> DataFrame:
    b = sized_broadcast(batches.select(F.col("batch_date").alias("__b")).distinct())
    return (control.where(F.col("dimension_name") == dimension)
            .join(b, F.col("batch_date") == F.col("__b"), "left_semi").select("run_id").distinct())


def rows_of_runs(dim: DataFrame, run_ids: DataFrame) -> DataFrame:
    """Dimension rows last touched by one of ``run_ids`` (bounded list: broadcast)."""
    r = sized_broadcast(run_ids.select(F.col("run_id").alias("__r")).distinct())
    return dim.join(r, F.col("last_updated_run_id") == F.col("__r"), "left_semi")


def latest_version(control: DataFrame) -> DataFrame:
    """Per dimension: contract version of the latest processed batch."""
    return control.groupBy("dimension_name").agg(
        F.max_by("contract_version", F.struct("processed_on", "batch_date")).alias("latest_version"))


def contract_change(control: DataFrame, specs: DataFrame) -> DataFrame:
    """Dimensions needing a full rebuild: applied batches exist and the version moved."""
    latest = latest_version(control)
    j = specs.join(latest, "dimension_name", "left")
    return j.select("dimension_name", "latest_version", "spec_version",
                    (F.col("latest_version").isNotNull() &
                     (F.col("latest_version") != F.col("spec_version"))).alias("force_rebuild"))


def late_arrival(applied: DataFrame, pending: DataFrame, col: str = "batch_date") -> DataFrame:
    """One row: earliest pending, latest applied, and whether a rebuild is needed."""
    a = applied.agg(F.max(col).alias("max_applied"))
    p = pending.agg(F.min(col).alias("min_pending"))
    max_applied = a.select("max_applied").scalar()
    return p.select("min_pending", max_applied.alias("max_applied"),
                    F.coalesce(F.col("min_pending") < max_applied, F.lit(False)).alias("is_late"))


def missing_ingestion_state(valid_batches: DataFrame, ingested: DataFrame, col: str = "batch_date") -> DataFrame:
    """Valid-output batches that have no ingestion marker (must not be applied)."""
    return (valid_batches.select(col).distinct()
            .join(ingested.select(col).distinct(), col, "left_anti").orderBy(col))


def latest_row(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple (e.g. the latest DQ run).

    One aggregate -- ``max_by`` of the whole row over a struct of the order
    columns -- instead of a global sort and a limit.
    """
    cols = df.columns
    picked = df.agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in cols]),
                             F.struct(*[F.col(f"`{c}`") for c in order])).alias("__r"))
    return picked.where(F.col("__r").isNotNull()).select("__r.*")
