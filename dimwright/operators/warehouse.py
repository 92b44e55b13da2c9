"""Star-schema loading: calendar dimension, warehouse dimensions, facts."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.contract import DimensionSpec, FactSpec
from dimwright.functions.dates import date_id, day_of_week_sun0, quarter_end
from dimwright.operators.keys import assign_surrogate_keys
from dimwright.operators.plan_utils import counted_broadcast

CALENDAR_COLUMNS = ["date_id", "date", "year", "quarter", "month", "month_name", "day",
                    "day_of_week", "day_name", "week_of_year", "is_weekend", "is_month_start",
                    "is_month_end", "is_quarter_start", "is_quarter_end"]


def calendar(dates: DataFrame, date_col: str = "source_batch_date") -> DataFrame:
    """Every day from Jan 1 of the first year to Dec 31 of the last year of ``dates``.

    The bounds are one aggregate row; the exploded range is years x 366 rows.
    """
    bounds = dates.agg(F.min(F.col(date_col).cast("date")).alias("lo"),
                       F.max(F.col(date_col).cast("date")).alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(F.explode(F.sequence(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)),
        F.expr("INTERVAL 1 DAY"))).alias("date"))
    d = F.col("date")
    dow = day_of_week_sun0(d)
    return days.select(
        date_id(d).alias("date_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        dow.isin(0, 6).alias("is_weekend"),
        (F.dayofmonth(d) == 1).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
        ((F.dayofmonth(d) == 1) & F.month(d).isin(1, 4, 7, 10)).alias("is_quarter_start"),
        (d == quarter_end(d)).alias("is_quarter_end"),
    )


def surrogate_key_name(dim_name: str) -> str:
    return (dim_name[4:] if dim_name.startswith("dim_") else dim_name) + "_id"


def warehouse_dimension(dim: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Snapshot + dense surrogate key in natural-key order (initial load)."""
    return assign_surrogate_keys(dim, spec.nk_columns, surrogate_key_name(spec.name))


def fact_rows(base: DataFrame, base_spec: DimensionSpec, fact: FactSpec,
              dims: Mapping[str, DataFrame], batch_dates: DataFrame | None = None) -> DataFrame:
    """One row per base-dimension version: surrogate FKs, date key, measures.

    FK resolution is an inner join per dimension (rows without a match are
    dropped, as a warehouse FK would reject them; ``checks.fk_orphans`` lists
    them).  Dimensions are stored or checkpointed tables; those with few rows are
    counted and broadcast, so the fact is not shuffled on a handful of keys.
    ``batch_dates`` has one row per batch.
    """
    base_key = surrogate_key_name(base_spec.name)
    rows = base
    if batch_dates is not None:
        rows = rows.join(F.broadcast(batch_dates.select(F.col(fact.date_source).alias("__bd"))
                                     .distinct()),
                         F.col(fact.date_source) == F.col("__bd"), "left_semi")
    out = [F.col(base_key)]
    for fk, dim_name, src, bk in fact.foreign_keys:
        d = dims[dim_name]
        key = surrogate_key_name(dim_name)
        side = counted_broadcast(d.select(F.col(bk).alias(f"__nk_{fk}"), F.col(key).alias(fk)))
        rows = rows.join(side, F.col(src) == F.col(f"__nk_{fk}"), "inner")
        out.append(F.col(fk))
    out.append(date_id(F.col(fact.date_source).cast("date")).alias("date_id"))
    out += [F.col(src).alias(m) for m, src in fact.measures]
    return rows.select(*out)
