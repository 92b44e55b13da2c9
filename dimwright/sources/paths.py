"""Filesystem helpers through the Hadoop FileSystem of the session (any scheme)."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import SparkSession

BATCH_DIR = re.compile(r"batch-(\d{4}-\d{2}-\d{2})")


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` (globs allowed) matches at least one file or directory.

    Only a path that is not there is False; a filesystem that cannot be asked raises.
    """
    fs, p = _fs_and_path(spark, path)
    matches = fs.globStatus(p)
    return matches is not None and len(matches) > 0


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Files without a byte that ``path`` (globs allowed) names or holds; markers and hidden files aside. A listing, no file is opened."""
    fs, p = _fs_and_path(spark, path)
    found = []
    for status in fs.globStatus(p) or ():
        for f in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
            name = f.getPath().getName()
            if not f.isDirectory() and f.getLen() == 0 and not name.startswith(("_", ".")):
                found.append(f.getPath().toString())
    return sorted(found)


def list_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the direct children of ``root`` (directory listing, metadata only)."""
    fs, p = _fs_and_path(spark, root)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def discover_batch_dates(spark: SparkSession, root: str) -> list[str]:
    """Sorted distinct ``batch-YYYY-MM-DD`` dates under ``root``; other names ignored.

    A directory listing: its size is the number of batches, not of records.
    """
    out = set()
    for name in list_names(spark, root):
        m = BATCH_DIR.fullmatch(name)
        if not m:
            continue
        try:
            out.add(date.fromisoformat(m.group(1)).isoformat())
        except ValueError:
            continue
    return sorted(out)


def split_uri(path: str) -> tuple[str, str]:
    """'s3a://bucket/key/x' -> ('bucket', 'key/x')."""
    m = re.match(r"^[a-zA-Z0-9]+://([^/]+)/?(.*)$", path)
    if not m:
        raise ValueError(f"not a URI with a bucket: {path}")
    return m.group(1), m.group(2)
