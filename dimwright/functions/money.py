"""Exact money arithmetic: sums in integer cents, HALF_UP rounding in integers.

Doubles are converted to cents once (values carry at most two decimals), so
sums and averages are exact and identical on every engine and partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(c: Column) -> Column:
    return F.round(c * F.lit(100)).cast("long")


def cents_to_amount(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def int_div(a: Column, b: Column) -> Column:
    """Integral division of longs (SQL ``a div b``)."""
    return F.call_function("div", a.cast("long"), F.nullif(b.cast("long"), F.lit(0).cast("long")))


def half_up_div(num: Column, den: Column) -> Column:
    """round(num / den) HALF_UP (halves away from zero) for den > 0, exact."""
    n, d = num.cast("long"), den.cast("long")
    return F.signum(n).cast("long") * int_div(F.abs(n) * 2 + d, d * 2)


def rounded_pct(part: Column, total: Column) -> Column:
    """part / total * 100 rounded HALF_UP to 2 decimals; 0 when total = 0."""
    hundredths = half_up_div(part.cast("long") * 10000, total)
    return F.when(total > 0, hundredths.cast("double") / F.lit(100.0)).otherwise(F.lit(0.0))


def avg_amount(sum_cents: Column, n: Column) -> Column:
    """Average amount rounded HALF_UP to cents (halves away from zero)."""
    return F.when(n > 0, cents_to_amount(half_up_div(sum_cents, n)))
