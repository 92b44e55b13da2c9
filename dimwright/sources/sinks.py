"""Writers.  Outputs are idempotent per batch; snapshots are versioned.

* ``write_split`` writes the classified feed once, partitioned by batch date
  and part, with the record status as a column: the source is parsed once, and
  a re-run replaces a batch as one unit, so a row that changed its status is
  not left in the other set.  The batch job writes one part per batch; a stream
  writes one per micro-batch, so a retry replaces its own rows only and later
  files of the same batch add to it.  New rows are written before old ones go.
* ``write_snapshot`` never overwrites a path the plan may be reading: each
  commit goes to a new version directory and a small pointer file names the
  current one (write new data first, then repoint).
* ``write_parts`` does the same for a table cut into parts by a column (a
  bucket of the key, a date): a commit writes the parts it replaces into new
  directories below them, ``<column>=<value>/written=<id>``, and the pointer names
  the current directory of each part.  All other parts keep their files.
"""

from __future__ import annotations

import json
import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimwright.operators.validate import ERRORS_COL, STATUS_COL
from dimwright.sources.paths import _fs_and_path, list_names, path_exists


#: partition level below the batch, and the part that the batch job writes
PART_COL = "ingest_part"
BATCH_PART = "batch"


def write_split(classified: DataFrame, path: str, batch_col: str = "source_batch_date", fmt: str = "parquet",
                batches: list[str] | None = None, part: str = BATCH_PART) -> None:
    """Replace ``part`` of the batches that ``classified`` holds.

    ``batches`` names batches that the rows hold as a whole: once they are written, every other part of
    them goes, and a batch without any row left leaves nothing behind.
    """
    spark = classified.sparkSession
    rows = classified
    if batches:
        counter = Observation("rows of each batch")
        rows = rows.observe(counter, *[F.count_if(F.col(batch_col) == F.lit(b).cast("date")).alias(b) for b in batches])
    (rows.withColumn(PART_COL, F.lit(part)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(batch_col, PART_COL)
     .format(fmt).save(path))
    for b in batches or ():
        batch = f"{path.rstrip('/')}/{batch_col}={b}"
        kept = f"{PART_COL}={part}" if dict(counter.get).get(b) else None
        for name in list_names(spark, batch):
            if name != kept:
                fs, p = _fs_and_path(spark, f"{batch}/{name}")
                fs.delete(p, True)
        if kept is None:
            fs, p = _fs_and_path(spark, batch)
            fs.delete(p, True)


def read_split(spark: SparkSession, path: str, status: str, batch_dates: list[str] | None = None,
               batch_col: str = "source_batch_date") -> DataFrame:
    """Valid or invalid rows; partition pruning on batches, the status is pushed to the files."""
    df = spark.read.parquet(path).where(F.col(STATUS_COL) == status)
    if batch_dates is not None:
        df = df.where(F.col(batch_col).isin([F.lit(d).cast("date") for d in batch_dates]))
    df = df.drop(STATUS_COL, PART_COL)
    return df.drop(ERRORS_COL) if status == "valid" else df


def partition_values(spark: SparkSession, path: str, col: str) -> list[str]:
    """Values of a partition column, from the directory listing (no file is opened)."""
    prefix = f"{col}="
    return sorted(n[len(prefix):] for n in list_names(spark, path) if n.startswith(prefix))


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside ``path``, then rename over it: a reader sees the old text or the new one."""
    beside = f"{path}.{uuid.uuid4().hex}"
    fs, p = _fs_and_path(spark, beside)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(p, jvm.org.apache.hadoop.fs.Path(path), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    if not path_exists(spark, path):
        return None
    fs, p = _fs_and_path(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def snapshot_meta(spark: SparkSession, root: str) -> dict | None:
    """The ``_CURRENT`` pointer: version path plus metadata written with it."""
    txt = read_text(spark, f"{root.rstrip('/')}/_CURRENT")
    return json.loads(txt) if txt else None


def current_snapshot(spark: SparkSession, root: str) -> str | None:
    meta = snapshot_meta(spark, root)
    return meta["path"] if meta else None


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    p = current_snapshot(spark, root)
    return spark.read.parquet(p) if p else None


#: versions of a snapshot on storage, the current one included
KEPT_VERSIONS = 4


def write_snapshot(df: DataFrame, root: str, partition_by: list[str] | None = None,
                   meta: dict | None = None) -> str:
    """Write a new snapshot version, then repoint ``_CURRENT`` to it (with ``meta``).

    The versions before it stay readable for plans that still use them; of
    those, the last ``KEPT_VERSIONS`` are kept.
    """
    spark = df.sparkSession
    before = snapshot_meta(spark, root) or {}
    version = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(version)
    versions = [version, *(before.get("versions") or ([before["path"]] if before else []))]
    _write_text(spark, f"{root.rstrip('/')}/_CURRENT",
                json.dumps({**(meta or {}), "path": version, "versions": versions[:KEPT_VERSIONS]}))
    for old in versions[KEPT_VERSIONS:]:
        fs, p = _fs_and_path(spark, old)
        fs.delete(p, True)
    return version


#: level below a part: one directory per write
WRITTEN_COL = "written"


def write_parts(df: DataFrame, root: str, part_col: str, parts: list[str] | None = None, meta: dict | None = None,
                observe: dict[str, Column] | None = None, publish: Callable[[dict], dict] | None = None) -> dict:
    """Replace ``parts`` (values of ``part_col``; default: every part) of a stored table by the rows of ``df``.

    The rows are dealt out by part (a part with many of them to several tasks), written beside what is there, and
    published by one pointer that names each part's directory; a part to be replaced that got no row is empty from
    then on.  Rows outside of ``parts`` are refused before anything is published.  Of each part the last
    ``KEPT_VERSIONS`` directories stay for plans that still read them.  Returns the ``observe`` aggregates over the
    rows.  The pointer also holds ``meta`` (or what ``publish`` makes of those aggregates) and the schema, so that
    reading opens no file to find it.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    before = snapshot_meta(spark, root) or {}
    known: dict[str, list] = before.get("parts") or {}
    if parts is not None and known and T.StructType.fromJson(before["schema"]).simpleString() != df.schema.simpleString():
        raise ValueError(f"{root}: some parts cannot be written with another schema than the others have")
    written_id, seen = uuid.uuid4().hex, Observation("parts written")
    metrics = {"__parts": F.collect_set(F.col(part_col).cast("string")), **(observe or {})}
    out = df.observe(seen, *[c.alias(n) for n, c in metrics.items()]).withColumn(WRITTEN_COL, F.lit(written_id))
    out.hint("rebalance", part_col).write.mode("append").partitionBy(part_col, WRITTEN_COL).parquet(root)
    got = dict(seen.get)
    written, replaced = set(got.pop("__parts", None) or []), set(known if parts is None else map(str, parts))
    if parts is not None and written - replaced:
        raise ValueError(f"{root}: rows outside of the parts to replace: {sorted(written - replaced)[:5]}")
    current, stale = dict(known), []
    for value in written | replaced:
        versions = [written_id if value in written else None, *known.get(value, [])]
        current[value] = versions[:KEPT_VERSIONS]
        stale += [f"{root}/{part_col}={value}/{WRITTEN_COL}={v}" for v in versions[KEPT_VERSIONS:] if v]
    meta = publish(got) if publish else meta
    _write_text(spark, f"{root}/_CURRENT", json.dumps({**(meta or {}), "part_col": part_col, "parts": current,
                                                       "schema": df.schema.jsonValue()}))
    if before.get("path"):  # stored as a whole before
        stale += before.get("versions") or [before["path"]]
    for old in stale:
        fs, p = _fs_and_path(spark, old)
        fs.delete(p, True)
    return got


def read_parts(spark: SparkSession, root: str, parts: list[str] | None = None) -> DataFrame | None:
    """The current rows of a table of parts (of some of them); None if there is no such table."""
    root = root.rstrip("/")
    meta = snapshot_meta(spark, root)
    if not meta:
        return None
    if "parts" not in meta:
        return spark.read.parquet(meta["path"])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in T.StructType.fromJson(meta["schema"])])
    wanted = None if parts is None else set(map(str, parts))
    paths = [f"{root}/{meta['part_col']}={value}/{WRITTEN_COL}={versions[0]}" for value, versions in meta["parts"].items()
             if versions[0] and (wanted is None or value in wanted)]
    if not paths:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField(WRITTEN_COL, T.StringType())])
    df = spark.read.schema(stored).option("basePath", root).parquet(*paths)
    return df.select(*[F.col(f"`{c}`") for c in schema.names])


def jdbc_options(url: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra) -> dict:
    """Options for the optional JDBC sink (the engine itself needs no database)."""
    opts = {"url": url, **extra}
    if user:
        opts["user"] = user
    if password:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    return opts


def write_jdbc(df: DataFrame, table: str, options: dict, mode: str = "append",
               num_partitions: int | None = None) -> None:
    """Publish a result table to an external database (optional sink).

    ``num_partitions`` bounds concurrent connections: the frame is coalesced
    (no shuffle) before the write.
    """
    if num_partitions:
        df = df.coalesce(num_partitions)
    df.write.format("jdbc").options(**options).option("dbtable", table).mode(mode).save()
