"""Data-quality metrics as DataFrame aggregations (no driver-side accumulators).

Per-batch and all-batch figures come from one pass: a per-(batch, key)
pre-aggregate combines map-side, so a hot key (or the NULL key) never reaches
one task whole; distinct keys per batch and across batches are then counted
from that pre-aggregate.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.functions.money import rounded_pct
from dimwright.operators.validate import ERRORS_COL


def duplicate_rate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total, distinct key tuples (NULL counts as a value), rate %."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    g = per_key.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("total_records"),
                    F.count(F.lit(1)).alias("distinct_keys"))
    return g.select("total_records", "distinct_keys",
                    (F.col("total_records") - F.col("distinct_keys")).alias("duplicate_count"),
                    rounded_pct(F.col("total_records") - F.col("distinct_keys"),
                                F.col("total_records")).alias("duplicate_rate"))


def duplicate_rate_by_batch(df: DataFrame, keys: Sequence[str], batch_col: str) -> DataFrame:
    """Rows per batch plus one all-batch row (``batch`` NULL, ``is_total`` true).

    A key repeated across batches is a duplicate in the all-batch row.
    """
    pre = df.groupBy(batch_col, *keys).agg(F.count(F.lit(1)).alias("__n"))
    per_batch = pre.groupBy(batch_col).agg(F.sum("__n").cast("long").alias("total_records"),
                                           F.count(F.lit(1)).alias("distinct_keys"))
    overall = (pre.groupBy(*keys).agg(F.sum("__n").alias("__n"))
               .agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("total_records"),
                    F.count(F.lit(1)).alias("distinct_keys"))
               .select(F.lit(None).cast(df.schema[batch_col].dataType).alias(batch_col),
                       F.lit(True).alias("is_total"), "total_records", "distinct_keys"))
    both = per_batch.select(batch_col, F.lit(False).alias("is_total"), "total_records", "distinct_keys").unionByName(overall)
    return both.select(
        F.col(batch_col).alias("batch"),
        "is_total",
        "total_records", "distinct_keys",
        rounded_pct(F.col("total_records") - F.col("distinct_keys"), F.col("total_records"))
        .alias("duplicate_rate"))


def ledger(classified: DataFrame, batch_col: str, status_col: str, keys: Sequence[str]) -> DataFrame:
    """Rows of each (batch, status, key): what every count and duplicate rate, per batch or over all, is added up from.

    A batch's rows depend on that batch alone, so a stored ledger is extended batch by batch.
    """
    return classified.groupBy(batch_col, status_col, *keys).agg(F.count(F.lit(1)).alias("n"))


def ledger_counts(entries: DataFrame, batch_col: str, status_col: str) -> DataFrame:
    """Valid and invalid records per batch."""
    per = lambda st: F.coalesce(F.sum(F.when(F.col(status_col) == st, F.col("n"))), F.lit(0)).cast("long")
    return entries.groupBy(batch_col).agg(per("valid").alias("valid_records"), per("invalid").alias("invalid_records"))


def ledger_duplicate_rates(entries: DataFrame, batch_col: str, status_col: str, keys: Sequence[str]) -> DataFrame:
    """Per status: rows per batch and one over all batches (``batch`` NULL, ``is_total`` true).

    A key repeated across batches is a duplicate in the all-batch row; NULL counts as a value.
    """
    figures = (F.sum("n").cast("long").alias("total_records"), F.count(F.lit(1)).alias("distinct_keys"))
    per_batch = entries.groupBy(status_col, batch_col).agg(*figures).select(
        status_col, F.col(batch_col).alias("batch"), F.lit(False).alias("is_total"), "total_records", "distinct_keys")
    overall = entries.groupBy(status_col, *keys).agg(F.sum("n").alias("n")).groupBy(status_col).agg(*figures).select(
        status_col, F.lit(None).cast(entries.schema[batch_col].dataType).alias("batch"), F.lit(True).alias("is_total"),
        "total_records", "distinct_keys")
    return per_batch.unionByName(overall).withColumn("duplicate_rate", rounded_pct(
        F.col("total_records") - F.col("distinct_keys"), F.col("total_records")))


def error_breakdown(invalid: DataFrame) -> DataFrame:
    """(field, code, error_count) over the error maps (classified or invalid rows)."""
    return (invalid.select(F.explode(ERRORS_COL).alias("field", "codes"))
            .select("field", F.explode("codes").alias("code"))
            .groupBy("field", "code").agg(F.count(F.lit(1)).alias("error_count")))


def breakdown_from_violations(violations: DataFrame) -> DataFrame:
    """(field, code, error_count) from a long-form violation list."""
    return violations.groupBy("field", "code").agg(F.count(F.lit(1)).alias("error_count"))


def nested_breakdown(breakdown: DataFrame) -> DataFrame:
    """One row: map field -> map code -> count, both levels sorted by key."""
    inner = breakdown.groupBy("field").agg(F.map_from_entries(F.array_sort(
        F.collect_list(F.struct("code", "error_count")))).alias("codes"))
    # entries hold a map (not orderable): sort them by field name explicitly
    by_field = F.array_sort(F.collect_list(F.struct("field", "codes")),
                            lambda a, b: F.when(a["field"] < b["field"], -1)
                            .when(a["field"] > b["field"], 1).otherwise(0))
    return inner.agg(F.map_from_entries(by_field).alias("error_breakdown"))


def batch_counts(classified: DataFrame, batch_col: str, status_col: str) -> DataFrame:
    """Valid / invalid / total per batch and for all batches (rollup)."""
    g = (classified.rollup(batch_col)
         .agg(F.count_if(F.col(status_col) == "valid").alias("valid_records"),
              F.count_if(F.col(status_col) == "invalid").alias("invalid_records"),
              F.grouping(batch_col).alias("__g")))
    return g.select(F.col(batch_col).alias("batch"), (F.col("__g") == 1).alias("is_total"),
                    "valid_records", "invalid_records",
                    (F.col("valid_records") + F.col("invalid_records")).alias("total_records"))


def reconciliation(inputs: DataFrame, outputs: DataFrame, batch_col: str) -> DataFrame:
    """Per batch and overall: input - (valid + invalid); non-zero means lost rows.

    ``inputs``: (batch, input_record_count) control rows; ``outputs``: classified rows.
    """
    i = inputs.groupBy(F.col(batch_col).alias("batch")).agg(
        F.coalesce(F.sum("input_record_count"), F.lit(0)).cast("long").alias("input_records"))
    return reconciled(i, outputs.groupBy(F.col(batch_col).alias("batch")).agg(
        F.count_if(F.col("record_status") == "valid").alias("valid_records"),
        F.count_if(F.col("record_status") == "invalid").alias("invalid_records")))


def reconciled(i: DataFrame, o: DataFrame) -> DataFrame:
    """Counts of what came in and of what is there, per ``batch``, side by side with a total row."""
    j = i.join(o, "batch", "full_outer").na.fill(0, ["input_records", "valid_records",
                                                     "invalid_records"])
    per = j.select("batch", F.lit(False).alias("is_total"), "input_records", "valid_records",
                   "invalid_records")
    tot = per.agg(F.lit(None).cast("date").alias("batch"), F.lit(True).alias("is_total"),
                  F.sum("input_records").cast("long").alias("input_records"),
                  F.sum("valid_records").cast("long").alias("valid_records"),
                  F.sum("invalid_records").cast("long").alias("invalid_records"))
    both = per.unionByName(tot)
    out = F.col("valid_records") + F.col("invalid_records")
    return both.select("*", out.alias("output_total"),
                       (F.col("input_records") - out).alias("difference"))


def dimension_counts(dims: Mapping[str, DataFrame]) -> DataFrame:
    """Per dimension: total rows; current / historical for versioned ones."""
    parts = []
    for name, df in dims.items():
        if "is_current" in df.columns:
            agg = df.agg(F.count(F.lit(1)).alias("total_rows"),
                         F.count_if(F.col("is_current")).alias("current_rows"),
                         F.count_if(~F.col("is_current")).alias("historical_rows"))
        else:
            agg = df.agg(F.count(F.lit(1)).alias("total_rows"),
                         F.lit(None).cast("long").alias("current_rows"),
                         F.lit(None).cast("long").alias("historical_rows"))
        parts.append(agg.select(F.lit(name).alias("dimension_name"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def per_batch_json(batch_col: str, value_col: str) -> Column:
    """Aggregate expression: JSON object {batch: value} with keys in batch order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct(F.col(batch_col).cast("string").alias("k"), F.col(value_col).alias("v"))))))


def breakdown_json(breakdown: DataFrame) -> DataFrame:
    """One row: the nested breakdown {field: {code: count}} as a JSON object, keys sorted."""
    return nested_breakdown(breakdown).select(F.to_json("error_breakdown").alias("error_breakdown"))


def combine_rows(frames: list[DataFrame]) -> DataFrame:
    """Collapse one-row aggregates with disjoint columns into one row.

    The frames are aligned (typed NULLs for foreign columns), unioned and
    reduced with ``first(ignorenulls)``: every source runs exactly once and no
    join (let alone a cross join) is needed to put the figures side by side.
    """
    types: dict = {}
    for f in frames:
        for fld in f.schema.fields:
            types.setdefault(fld.name, fld.dataType)
    cols = list(types)
    aligned = [f.select(*[(F.col(f"`{c}`") if c in f.columns else F.lit(None).cast(types[c])).alias(c)
                          for c in cols]) for f in frames]
    out = aligned[0]
    for a in aligned[1:]:
        out = out.unionByName(a)
    return out.agg(*[F.first(F.col(f"`{c}`"), ignorenulls=True).alias(c) for c in cols])


def duplicate_rates_by_status(classified: DataFrame, keys: Sequence[str],
                              status_col: str = "record_status") -> DataFrame:
    """Duplicate rate of every status set (valid, invalid) from ONE pre-aggregate.

    One row per status: total, distinct key tuples (NULL counts as a value), rate %.
    """
    per_key = classified.groupBy(status_col, *keys).agg(F.count(F.lit(1)).alias("__n"))
    g = per_key.groupBy(status_col).agg(F.sum("__n").cast("long").alias("total_records"),
                                        F.count(F.lit(1)).alias("distinct_keys"))
    return g.select(status_col, "total_records", "distinct_keys",
                    rounded_pct(F.col("total_records") - F.col("distinct_keys"),
                                F.col("total_records")).alias("duplicate_rate"))
