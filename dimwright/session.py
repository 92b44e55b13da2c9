"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "dimwright",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings every job relies on.

    On a cluster, spark-submit supplies master and sizing: without
    ``shuffle_partitions`` the session's own ``spark.sql.shuffle.partitions`` stays.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # partitionBy(...).mode("overwrite") replaces only the partitions written
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # checkpoint files go when nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``.  Only a local
    master, whose executors are threads of this process, may do without: it
    gets a private temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not _one_machine(sc.master):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="dimwright-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir



def _one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")
