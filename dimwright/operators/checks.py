"""Integrity checks.  Each returns the violating rows: empty means pass.

Every check is a distributed aggregation or join over whole tables; none
samples an entity or collects rows to the driver.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(n: str) -> Column:
    return F.col(f"`{n}`")


def one_current(dim: DataFrame, key: str) -> DataFrame:
    """Entities whose number of current versions is not exactly one (zero included)."""
    return (dim.groupBy(key).agg(F.count_if(_c("is_current")).alias("current_count"))
            .where(F.col("current_count") != 1))


def current_is_latest(dim: DataFrame, key: str) -> DataFrame:
    """Current rows whose start is not the entity's latest start; the versions pass once."""
    latest = F.max("start_date").over(Window.partitionBy(_c(key)))
    return (dim.where(_c(key).isNotNull()).select(key, "start_date", "is_current").withColumn("latest_start", latest)
            .where(_c("is_current") & (F.col("start_date") < F.col("latest_start")))
            .select(key, "start_date", "latest_start"))


def natural_key_dups(dim: DataFrame, nk: Sequence[str]) -> DataFrame:
    return dim.groupBy(*nk).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def start_eq_batch(dim: DataFrame, key: str, batch_col: str = "source_batch_date") -> DataFrame:
    return (dim.where(~F.col("start_date").eqNullSafe(F.col(batch_col).cast("date")))
            .select(key, "start_date", batch_col))


def open_sentinel(dim: DataFrame, key: str, sentinel: str = "2099-12-31") -> DataFrame:
    """End date NULL, or a current row not ending at the sentinel."""
    s = F.lit(sentinel).cast("date")
    bad = F.col("end_date").isNull() | (_c("is_current") & (F.col("end_date") != s))
    return dim.where(bad).select(key, "start_date", "end_date", "is_current")


def gapless_versions(dim: DataFrame, key: str) -> DataFrame:
    """Closed versions whose end is not the next version's start minus one day."""
    w = Window.partitionBy(key).orderBy("start_date")
    nxt = F.lead("start_date").over(w)
    v = dim.select(key, "start_date", "end_date", nxt.alias("next_start"))
    return v.where(F.col("next_start").isNotNull() &
                   ~F.col("end_date").eqNullSafe(F.date_sub("next_start", 1)))


def versions_differ(dim: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Adjacent versions of an entity equal in every tracked field (all entities)."""
    w = Window.partitionBy(key).orderBy("start_date")
    same = F.lit(True)
    for f in tracked:
        same = same & _c(f).eqNullSafe(F.lag(_c(f)).over(w))
    first = F.lag("start_date").over(w).isNull()
    return (dim.select(key, "start_date", (~first & same).alias("__same"))
            .where("__same").drop("__same"))


def first_seen(dim: DataFrame, feed: DataFrame, key: str, batch_col: str = "source_batch_date") -> DataFrame:
    """Entities whose stored first batch differs from the first batch they appear in."""
    seen = feed.groupBy(key).agg(F.min(batch_col).alias("first_seen"))
    stored = dim.groupBy(key).agg(F.min(batch_col).alias("stored_first"))
    return stored.join(seen, key).where(~F.col("stored_first").eqNullSafe(F.col("first_seen")))


def fact_first_seen(fact: DataFrame, dim: DataFrame, feed: DataFrame, *, key: str, dim_key: str,
                    batch_col: str = "source_batch_date") -> DataFrame:
    """Single-version entities whose fact date is not their first-seen batch."""
    single = dim.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n = 1").select(key)
    seen = feed.groupBy(key).agg(F.min(batch_col).alias("first_seen"))
    f = fact.join(dim.select(dim_key, key), dim_key).join(single, key, "left_semi")
    expect = (F.year("first_seen") * 10000 + F.month("first_seen") * 100
              + F.dayofmonth("first_seen")).cast("int")
    return (f.join(seen, key).where(F.col("date_id") != expect)
            .select(key, "date_id", expect.alias("expected_date_id")))


def fk_orphans(base: DataFrame, dim: DataFrame, fk_src: str, dim_key: str, keep: Sequence[str]) -> DataFrame:
    """Base rows whose foreign natural key has no dimension row."""
    d = dim.select(F.col(dim_key).alias("__dk")).distinct()
    return base.join(d, F.col(fk_src) == F.col("__dk"), "left_anti").select(*keep, fk_src)


def domain(df: DataFrame, col: str, allowed: Sequence, keep: Sequence[str]) -> DataFrame:
    """Non-NULL values outside an allowed set (CHECK constraint)."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed))).select(*keep, col)


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, null_count) for columns that contain NULLs; one pass over the data."""
    counts = df.agg(*[F.count_if(_c(c).isNull()).alias(c) for c in cols])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), _c(c).alias("null_count")) for c in cols])).alias("s"))
    return stacked.select("s.*").where(F.col("null_count") > 0)


def invalid_structure(invalid: DataFrame, declared: Sequence[str], key: str) -> DataFrame:
    """Invalid rows with an empty error map or errors for undeclared fields."""
    extra = F.array_except(F.map_keys("validation_errors"), F.array(*[F.lit(d) for d in declared]))
    return (invalid.select(key, F.array_join(F.array_sort(extra), ",").alias("unexpected_fields"),
                           F.size("validation_errors").alias("error_fields"))
            .where((F.col("unexpected_fields") != "") | (F.col("error_fields") <= 0)))


def valid_structure(valid: DataFrame, rules, key: str, lineage: Sequence[str]) -> DataFrame:
    """Rows of the valid set that break a rule after all or lack a lineage value: (key, field, code)."""
    from dimwright.operators.validate import violations

    broken = violations(valid, rules, [key])
    gaps = F.filter(F.array(*[F.when(_c(c).isNull(), F.lit(c)) for c in lineage]), lambda c: c.isNotNull())
    missing = valid.select(key, F.explode(gaps).alias("field")).select(key, "field", F.lit("missing").alias("code"))
    return broken.unionByName(missing)


def dq_row_consistent(metrics: DataFrame) -> DataFrame:
    """Issues inside stored metrics rows: (run_id, issue) where the figures of a run contradict each other."""
    def per_batch_sum(col: str) -> Column:
        counts = F.map_values(F.from_json(_c(col), "map<string,bigint>"))
        return F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)

    issues = {
        "total": _c("total_records") != _c("valid_records") + _c("invalid_records"),
        "difference": _c("reconciliation_difference") != _c("input_records") - _c("total_records"),
        "lost_records": _c("reconciliation_difference") != 0,
        "per_batch_valid": per_batch_sum("per_batch_valid") != _c("valid_records"),
        "per_batch_invalid": per_batch_sum("per_batch_invalid") != _c("invalid_records"),
        "batch_count": F.size(F.json_object_keys(_c("per_batch_valid"))) != _c("batch_count"),
        "rates": (_c("total_records") > 0) & (F.abs(_c("valid_rate") + _c("invalid_rate") - 100) > 0.011),
    }
    found = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in issues.items()]),
                     lambda c: c.isNotNull())
    return metrics.select("run_id", F.explode(found).alias("issue"))


def dq_consistent(reconciliation: DataFrame) -> DataFrame:
    """Reconciliation rows with a non-zero difference, and per-batch sums != totals.

    The totals and the per-batch sums come from one aggregate in the same plan
    as the difference rows (identical exchanges are reused), rather than from
    scalar subqueries that would each re-run the reconciliation.
    """
    tot, per = F.col("is_total"), ~F.col("is_total")
    agg = reconciliation.agg(
        (F.max(F.when(tot, F.col("input_records"))) - F.sum(F.when(per, F.col("input_records"))))
        .alias("d_in"),
        (F.max(F.when(tot, F.col("valid_records"))) - F.sum(F.when(per, F.col("valid_records"))))
        .alias("d_valid"),
        (F.max(F.when(tot, F.col("invalid_records"))) - F.sum(F.when(per, F.col("invalid_records"))))
        .alias("d_invalid"))
    mism = agg.select(F.explode(F.array(
        F.struct(F.lit("per_batch_sum").alias("issue"), F.col("d_in").alias("delta")),
        F.struct(F.lit("per_batch_valid_sum").alias("issue"), F.col("d_valid").alias("delta")),
        F.struct(F.lit("per_batch_invalid_sum").alias("issue"), F.col("d_invalid").alias("delta")))).alias("m")) \
        .select("m.issue", F.lit(None).cast("date").alias("batch"), "m.delta")
    diff = reconciliation.where(F.col("difference") != 0).select(
        F.lit("difference").alias("issue"), "batch", F.col("difference").alias("delta"))
    return diff.unionByName(mism.where(F.col("delta") != 0))


def snapshot_equivalence(snapshot: DataFrame, warehouse: DataFrame, nk: Sequence[str],
                         fields: Sequence[str]) -> DataFrame:
    """Keyed comparison: rows missing on either side or differing in any field."""
    s = snapshot.select(*nk, F.struct(*[_c(f) for f in fields]).alias("__s"))
    w = warehouse.select(*nk, F.struct(*[_c(f) for f in fields]).alias("__w"))
    j = s.join(w, list(nk), "full_outer")
    issue = (F.when(F.col("__w").isNull(), F.lit("missing_in_warehouse"))
             .when(F.col("__s").isNull(), F.lit("missing_in_snapshot"))
             .when(~F.col("__s").eqNullSafe(F.col("__w")), F.lit("different")))
    return j.select(*nk, issue.alias("issue")).where(F.col("issue").isNotNull())


def bucket_digests(df: DataFrame, nk: Sequence[str], fields: Sequence[str], buckets: int) -> DataFrame:
    """Per hash bucket of the key: rows, and the sum of the row hashes, which no order of the rows changes."""
    bucket = F.pmod(F.xxhash64(*[_c(c) for c in nk]), F.lit(buckets)).alias("bucket")
    row = F.xxhash64(*[_c(c) for c in (*nk, *fields)]).cast("decimal(38,0)")
    # a hash passes over NULLs, so which fields are NULL is hashed with the row
    nulls = F.xxhash64(F.array(*[_c(c).isNull() for c in (*nk, *fields)])).cast("decimal(38,0)")
    return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("digest"), F.sum(row * nulls % F.lit(1 << 62)).alias("shape"))


def snapshot_differences(snapshot: DataFrame, warehouse: DataFrame, nk: Sequence[str], fields: Sequence[str],
                         buckets: int = 1024) -> DataFrame:
    """``snapshot_equivalence`` that joins only the buckets whose digests differ.

    Both sides are read and summed up without a shuffle of their rows; equal tables end there.  The list of
    differing buckets is at most ``buckets`` numbers."""
    s, w = (bucket_digests(d, nk, fields, buckets) for d in (snapshot, warehouse))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"w.{c}")) for c in ("rows", "digest", "shape")]
    j = s.alias("s").join(w.alias("w"), F.col("s.bucket") == F.col("w.bucket"), "full_outer")
    bad = [r["b"] for r in j.where(~(same[0] & same[1] & same[2])).select(F.coalesce("s.bucket", "w.bucket").alias("b")).collect()]
    here = F.pmod(F.xxhash64(*[_c(c) for c in nk]), F.lit(buckets)).isin(bad)
    return snapshot_equivalence(snapshot.where(here), warehouse.where(here), nk, fields)


def fact_measure(fact: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Fact rows with an unpopulated measure."""
    bad = F.lit(False)
    for m in measures:
        bad = bad | F.col(m).isNull()
    return fact.where(bad).select(key, *measures)


def fact_dates(fact: DataFrame, dim: DataFrame, batch_col: str = "source_batch_date") -> DataFrame:
    """Symmetric difference of fact date keys and dimension batch dates."""
    d = F.col(batch_col).cast("date")
    dim_ids = dim.select((F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
                         .alias("date_id")).distinct()
    fact_ids = fact.select("date_id").distinct()
    return (dim_ids.join(fact_ids, "date_id", "left_anti").select("date_id", F.lit("missing_in_fact").alias("side"))
            .unionByName(fact_ids.join(dim_ids, "date_id", "left_anti")
                         .select("date_id", F.lit("missing_in_dimension").alias("side"))))


def input_parseable(raw: DataFrame, group_col: str, order_col: str, text_col: str, schema: str,
                    groups: DataFrame | None = None) -> DataFrame:
    """Per input file/group: rows, unparseable rows, whether the first line parses.

    Only groups that fail (empty, or first line unparseable) are returned.  An
    empty file has no rows to group: ``groups`` (``group_col``, say from a directory
    listing) names the groups there should be.
    """
    ok = _parses(text_col, schema)
    g = raw.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~ok).alias("unparseable_rows"),
        F.min_by(ok, F.col(order_col)).alias("first_line_ok"))
    if groups is not None:
        g = groups.select(group_col).distinct().join(g, group_col, "left").select(
            group_col, F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"),
            F.coalesce("unparseable_rows", F.lit(0).cast("long")).alias("unparseable_rows"),
            F.coalesce("first_line_ok", F.lit(False)).alias("first_line_ok"))
    return g.where((F.col("row_count") == 0) | ~F.col("first_line_ok"))


def _parses(text_col: str, schema: str) -> Column:
    """True when the text is a JSON object whose declared fields all parse."""
    names = [p.strip().split()[0] for p in schema.split(",")]
    parsed = F.from_json(F.col(text_col), schema, {"mode": "PERMISSIVE"})
    ok = F.col(text_col).isNotNull() & F.json_object_keys(F.col(text_col)).isNotNull()
    for n in names:
        ok = ok & parsed[n].isNotNull()
    return F.coalesce(ok, F.lit(False))


def load_coverage(control: DataFrame, expected: DataFrame, dim_col: str = "dimension_name") -> DataFrame:
    """Expected dimensions with no warehouse-loaded batch."""
    loaded = control.groupBy(dim_col).agg(F.count_if(F.col("warehouse_loaded_at").isNotNull())
                                          .alias("loaded_batches"))
    return (expected.select(dim_col).join(loaded, dim_col, "left")
            .select(dim_col, F.coalesce("loaded_batches", F.lit(0)).alias("loaded_batches"))
            .where(F.col("loaded_batches") == 0))


def unchanged_single_version(dim: DataFrame, feed: DataFrame, key: str, tracked: Sequence[str],
                             batch_col: str = "source_batch_date") -> DataFrame:
    """Entities seen in several batches with constant tracked values but >1 version."""
    t = F.struct(*[_c(f) for f in tracked])
    stable = (feed.groupBy(key).agg(F.count_distinct(batch_col).alias("batches"),
                                    F.count_distinct(t).alias("__vals"))
              .where((F.col("batches") > 1) & (F.col("__vals") == 1)).drop("__vals"))
    versions = dim.groupBy(key).agg(F.count(F.lit(1)).alias("versions")).where("versions > 1")
    return stable.join(versions, key)
