"""Session settings and the shared scratch folder.

The audit jobs only need stock Spark: adaptive execution to coalesce the tiny
count shuffles, string partition values (a business date such as ``20220301``
must not turn into an integer), and a shared folder for anything that is
materialised between jobs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # partition values are compared as text, never re-typed by discovery
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # result tables are rewritten one partition_date at a time
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoints of a run are removed from the shared folder once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "copyaudit",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, catalog: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the audit relies on.

    ``catalog`` ("hive" or "in-memory") holds unless the launcher has set ``spark.sql.catalogImplementation``.
    """
    builder = SparkSession.builder.appName(app_name)
    if catalog and not SparkConf().contains("spark.sql.catalogImplementation"):
        builder = builder.config("spark.sql.catalogImplementation", catalog)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one (a laptop or a unit test) gets a folder of
    its own, registered so ``DataFrame.checkpoint()`` uses the same place; on a
    cluster a missing setting is an error, never a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="copyaudit-checkpoint-"))
        root = spark.sparkContext.getCheckpointDir()
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/copyaudit/{name}-{uuid.uuid4().hex[:12]}"
