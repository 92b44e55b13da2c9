"""Spans inside texts: code-point offsets, end exclusive."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

SPAN = StructType([StructField("kind", StringType()), StructField("start", LongType()),
                   StructField("end", LongType()), StructField("base", BooleanType())])
SPANS = ArrayType(SPAN)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span in the order given, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest_columns(spans: str, kinds: Sequence[str]) -> dict[str, Column]:
    """Counts per base kind, a hash of the base spans and all spans as text."""
    col = F.col(spans)
    base = F.filter(col, lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == F.lit(kind))).cast("long")

    out = {f"n_{k}": count(k) for k in kinds}
    out["base_sha256"] = F.sha2(joined(base).cast("binary"), 256)
    out["spans"] = joined(col)
    return out
