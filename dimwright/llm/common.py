"""Helpers shared by the operators: table access, Arrow batch mapping, shared scratch tables."""

from __future__ import annotations

import os
import uuid
from typing import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from dimwright.session import ensure_checkpoint_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: rows of an Arrow batch that are turned into Python objects at a time
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let_workers_import(spark: SparkSession) -> None:
    """Put the folder of this package on the Python workers' path, as an environment variable of the context.

    Needed where only the driver's own ``sys.path`` leads to it; harmless where the package is installed.
    """
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, _ROOT])


def add_columns(df: DataFrame, inputs: Sequence[str], fields: Sequence[StructField],
                make: Callable[[], Callable], keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``fields`` to the ``keep`` columns (default: all) of ``df``, computed in Arrow batches.

    ``make()`` runs once per task and returns ``fn(*lists) -> list of tuples`` (one tuple of
    new values per row).  A new column replaces an input column of the same name.  Rows,
    their order and partitioning stay as they are.
    """
    let_workers_import(df.sparkSession)
    new = [f.name for f in fields]
    lowered = {n.lower() for n in new}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in lowered]
    shadow = [f"__in{i}" for i in range(len(inputs))]
    src = df.select(*[F.col(f"`{c}`") for c in kept],
                    *[F.col(f"`{c}`").alias(s) for c, s in zip(inputs, shadow)])
    schema = StructType([src.schema[c] for c in kept] + list(fields))

    def run(batches: Iterator):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in fields]
        fn = make()
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(start, SLICE_ROWS)
                rows = fn(*[b.column(b.schema.get_field_index(s)).to_pylist() for s in shadow])
                cols = list(zip(*rows)) if rows else [[] for _ in types]
                yield pa.RecordBatch.from_arrays(
                    [b.column(i) for i in range(len(kept))]
                    + [pa.array(list(v), type=t) for v, t in zip(cols, types)], names=kept + new)

    return src.mapInArrow(run, schema)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder path inside the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: folders that ``save_table`` wrote and nobody dropped yet
_SAVED: list[str] = []


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, and the
    files survive lost executors.  They stay until ``drop_saved``: results read from them."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    _SAVED.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved() -> list[str]:
    """Folders written by ``save_table`` so far that are still there, oldest first."""
    return list(_SAVED)


def drop_saved(spark: SparkSession, paths: Sequence[str] | None = None) -> None:
    """Delete folders that ``save_table`` wrote (default: all), once what reads from them is written elsewhere."""
    for path in list(_SAVED if paths is None else paths):
        if path in _SAVED:
            _SAVED.remove(path)
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect a table that is small by nature; more rows than ``limit`` raise instead of
    flooding the driver."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return rows
