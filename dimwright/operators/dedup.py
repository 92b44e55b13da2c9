"""Keep the latest row per key under a total order (deterministic for any layout).

Fast path (every order column descending, or every one ascending, all columns
orderable): ``groupBy(key).agg(max(struct(order..., rest...)))``.  A struct
compares field by field, so the remaining columns break ties and the winner
is the same for any partitioning; the aggregate combines map-side, which keeps
a hot key (one key holding a third of the rows) from landing whole in one task.

General path (mixed directions): ``row_number`` over the key window with the
remaining columns as tie-breakers; Spark 4 plans a partial WindowGroupLimit
before the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType) or type(dt).__name__ == "VariantType":
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def dedup_latest(df: DataFrame, keys: Sequence[str],
                 order: Sequence[tuple[str, bool]] = (), method: str = "auto") -> DataFrame:
    """One row per ``keys``; winner = greatest by ``order`` [(column, descending)]."""
    keys = list(keys)
    order = [(c, bool(d)) for c, d in order if c in df.columns and c not in keys]
    cols = df.columns
    rest = [c for c in cols if c not in keys and c not in {o for o, _ in order}]
    dirs = {d for _, d in order}
    all_orderable = all(_orderable(f.dataType) for f in df.schema.fields if f.name not in keys)
    if method == "auto":
        method = "aggregate" if len(dirs) <= 1 and all_orderable else "window"
    if method == "aggregate":
        descending = dirs != {False}
        names = [c for c, _ in order] + rest
        packed = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(names)])
        pick = F.max(packed) if descending else F.min(packed)
        agg = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(pick.alias("__w"))
        return agg.select(*[F.col(f"`{c}`") if c in keys
                            else F.col(f"__w.f{names.index(c)}").alias(c) for c in cols])
    spec = [F.col(f"`{c}`").desc() if d else F.col(f"`{c}`").asc() for c, d in order]
    # tie-break like the aggregate path: greatest remaining row unless all ascending
    rest_desc = dirs != {False}
    spec += [F.col(f"`{c}`").desc() if rest_desc else F.col(f"`{c}`").asc() for c in rest
             if _orderable(df.schema[c].dataType)]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*spec)
    return (df.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1).drop("__rn"))
