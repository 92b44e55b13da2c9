"""Dated JSON-lines sources under a declared schema."""

from __future__ import annotations

from typing import Any, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimwright.contract import FeedSpec
from dimwright.sources.paths import path_exists


def batch_path(pattern: str, batch_date: str) -> str:
    return pattern.replace("{date}", str(batch_date))


def read_source(spark: SparkSession, feed: FeedSpec, batch_date: str | None = None,
                options: Mapping[str, Any] | None = None) -> DataFrame | None:
    """Read one batch of a feed.

    With schema enforcement, records are parsed PERMISSIVE under the declared
    schema: an unparsable line becomes an all-NULL row and a wrong-typed field
    becomes NULL, both caught later by ``notNull`` rules.  Blank lines vanish.
    Without enforcement the schema is inferred.  A missing path of an optional
    source returns ``None``; of a required source it raises.
    """
    path = batch_path(feed.path, batch_date) if batch_date else feed.path
    if not path_exists(spark, path):
        if feed.required:
            raise FileNotFoundError(f"required source {feed.name!r} not found at {path}")
        return None
    reader = spark.read.format(feed.format).options(**{**dict(feed.options), **dict(options or {})})
    reader = reader.option("mode", "PERMISSIVE")
    if feed.enforce_schema and feed.schema is not None:
        reader = reader.schema(feed.schema)
    return reader.load(path)


def parse_json_column(c: Column, schema: T.StructType | str) -> Column:
    """JSON text column -> struct under ``schema`` (PERMISSIVE: bad text -> NULL fields)."""
    return F.from_json(c, schema, {"mode": "PERMISSIVE"})
