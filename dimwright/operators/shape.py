"""Renames, derived fields, column alignment and load-time casts."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimwright.contract import LINEAGE_TYPES, DimensionSpec


def rename(df: DataFrame, renames: Sequence[tuple[str, str]] | Mapping[str, str]) -> DataFrame:
    pairs = dict(renames.items() if isinstance(renames, Mapping) else renames)
    present = {k: v for k, v in pairs.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def derive(df: DataFrame, derived: Sequence[tuple[str, str]]) -> DataFrame:
    """SQL expression strings from the contract, applied in declaration order."""
    for name, expr in derived:
        df = df.withColumn(name, F.expr(expr))
    return df


def align(df: DataFrame, columns: Sequence[str],
          types: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """Fixed column order; missing columns become typed NULLs; extras dropped."""
    types = dict(types or {})
    have = set(df.columns)
    out = []
    for c in columns:
        if c in have:
            out.append(F.col(f"`{c}`"))
        else:
            out.append(F.lit(None).cast(types.get(c, T.StringType())).alias(c))
    return df.select(*out)


def dimension_types(spec: DimensionSpec) -> dict[str, T.DataType]:
    t: dict[str, T.DataType] = dict(LINEAGE_TYPES)
    t.update({"start_date": T.DateType(), "end_date": T.DateType(),
              "is_current": T.BooleanType(), "last_updated_run_id": T.StringType()})
    return t


def align_dimension(df: DataFrame, spec: DimensionSpec) -> DataFrame:
    return align(df, spec.columns(), dimension_types(spec))


def cast_to(df: DataFrame, target: Mapping[str, str]) -> DataFrame:
    """Load-time casts into warehouse types.

    Strings go through ``try_cast`` (unparseable -> NULL, reported by checks);
    other sources use a plain cast (double -> decimal rounds HALF_UP).
    """
    out = []
    for f in df.schema.fields:
        name = f.name
        if name in target:
            c = F.col(f"`{name}`")
            if isinstance(f.dataType, T.StringType):
                out.append(c.try_cast(target[name]).alias(name))
            else:
                out.append(c.cast(target[name]).alias(name))
        else:
            out.append(F.col(f"`{name}`"))
    return df.select(*out)
