"""Mart views over the star schema (amounts summed exactly in cents).

A mart is computed as a whole (``active_by_tier``, ``amount_by_month_and``) or kept up to date
from the entities that a load touches: ``pairs`` holds what each entity adds to each group, so
that the old pairs of touched entities can be taken back and their new ones added
(``group_change``, ``merge_groups``) without reading any other entity.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.functions.money import avg_amount, cents_to_amount, to_cents
from dimwright.operators.plan_utils import sized_broadcast


def active_by_tier(fact: DataFrame, base: DataFrame, tier: DataFrame, *, base_key: str,
                   entity: str, tier_key: str, tier_name: str, measure: str,
                   status_col: str, active_value: str) -> DataFrame:
    """Current & active entities per tier: distinct count, average and total measure."""
    cur = base.where(F.col("is_current") & (F.col(status_col) == active_value)) \
        .select(base_key, entity)
    t = sized_broadcast(tier.select(tier_key, F.col(tier_name).alias("tier")))
    j = fact.join(cur, base_key).join(t, tier_key)
    g = j.groupBy("tier").agg(F.count_distinct(entity).alias("active_count"),
                              F.sum(to_cents(F.col(measure))).alias("__c"),
                              F.count(F.col(measure)).alias("__n"))
    return g.select("tier", "active_count",
                    avg_amount(F.col("__c"), F.col("__n")).alias("avg_amount"),
                    cents_to_amount(F.col("__c")).alias("total_amount"))


def amount_by_month_and(fact: DataFrame, base: DataFrame, other: DataFrame, calendar: DataFrame, *,
                        base_key: str, entity: str, other_key: str, other_name: str,
                        measure: str) -> DataFrame:
    """Year, month, month name and an attribute of another dimension: entities, total."""
    o = sized_broadcast(other.select(other_key, F.col(other_name).alias("group_name")))
    cal = sized_broadcast(calendar.select("date_id", "year", "month", "month_name"))
    j = (fact.join(base.select(base_key, entity), base_key)
         .join(o, other_key).join(cal, "date_id"))
    g = j.groupBy("year", "month", "month_name", "group_name").agg(
        F.count_distinct(entity).alias("entity_count"),
        F.sum(to_cents(F.col(measure))).alias("__c"))
    return (g.select("year", "month", "month_name", "group_name", "entity_count",
                     cents_to_amount(F.col("__c")).alias("total_amount"))
            .orderBy("year", "month", "group_name"))


def version_history(base: DataFrame, lookups: list[tuple[DataFrame, str, list[str]]],
                    columns: list[str], order: list[str]) -> DataFrame:
    """Every version with attributes of left-joined dimensions, ordered."""
    out = base
    for df, key, cols in lookups:
        out = out.join(sized_broadcast(df.select(key, *cols)), key, "left")
    return out.select(*columns).orderBy(*order)


# ---------------------------------------------------------------- marts kept up to date

@dataclass(frozen=True)
class MartSpec:
    """Distinct entities, rows and total of a measure per group, over the fact rows joined with their base versions.

    ``groups`` are (name, SQL expression over the columns of both); an expression may use what never changes for a stored
    row (keys, dates) or what changes only with a new version of its entity.  Attributes of other dimensions are joined
    to the groups when the mart is read, by key.
    """
    name: str
    fact: str
    entity: str
    measure: str
    groups: tuple[tuple[str, str], ...]
    where: str = "TRUE"

    @property
    def group_names(self) -> list[str]:
        return [n for n, _ in self.groups]


#: what a pair or a group adds up: rows, rows with a measure, and the measure in cents
TOTALS = ("n_rows", "n_measured", "cents")


def pairs(rows: DataFrame, spec: MartSpec) -> DataFrame:
    """What each entity adds to each group.  Rows without an entity are one pair per group, which counts no entity;
    a NULL measure counts as a row without a measure; a NULL group is a group."""
    picked = rows.where(spec.where).select(*[F.expr(e).alias(n) for n, e in spec.groups], F.col(f"`{spec.entity}`").alias("entity"),
                                           to_cents(F.col(f"`{spec.measure}`")).alias("__c"))
    return picked.groupBy(*[F.col(f"`{n}`") for n in spec.group_names], "entity").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("__c").alias("n_measured"), F.coalesce(F.sum("__c"), F.lit(0).cast("long")).alias("cents"))


def group_change(before: DataFrame | None, after: DataFrame, spec: MartSpec) -> DataFrame:
    """Change per group when the pairs ``before`` give way to the pairs ``after``; groups that stay equal give no row."""
    signed = after.withColumn("__sign", F.lit(1))
    if before is not None:
        signed = signed.unionByName(before.withColumn("__sign", F.lit(-1)))
    out = signed.groupBy(*[F.col(f"`{n}`") for n in spec.group_names]).agg(
        F.sum(F.when(F.col("entity").isNotNull(), F.col("__sign")).otherwise(0)).alias("entities"),
        *[F.sum(F.col("__sign") * F.col(t)).alias(t) for t in TOTALS])
    return out.where(" OR ".join(f"{c} <> 0" for c in ("entities", *TOTALS)))


def merge_groups(stored: DataFrame, change: DataFrame, spec: MartSpec) -> DataFrame:
    """Stored groups with a change added; a group that holds no row any more goes."""
    both = stored.unionByName(change)
    out = both.groupBy(*[F.col(f"`{n}`") for n in spec.group_names]).agg(*[F.sum(c).alias(c) for c in ("entities", *TOTALS)])
    return out.where("n_rows <> 0")


def served(groups: DataFrame) -> DataFrame:
    """Groups with their figures as a mart shows them: entities, rows, exact average and total."""
    return groups.select(*[c for c in groups.columns if c not in ("entities", *TOTALS)], F.col("entities").alias("entity_count"),
                         F.col("n_rows").alias("row_count"), avg_amount(F.col("cents"), F.col("n_measured")).alias("avg_amount"),
                         F.when(F.col("n_measured") > 0, cents_to_amount(F.col("cents"))).alias("total_amount"))
