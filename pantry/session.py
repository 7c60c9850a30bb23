"""SparkSession construction and cluster-wide settings used by every job."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  UTC because the reference stores TIMESTAMPTZ and
# compares against "now"; AQE so that join strategy (broadcast vs. sort-merge),
# partition coalescing and skew splitting are decided on runtime sizes.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "pantry") -> SparkSession:
    """A session with the settings above.  Without ``master`` the submitter's
    master, memory and sizes hold; tests and benchmarks name a local one."""
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master).config("spark.driver.memory", os.environ.get("PANTRY_DRIVER_MEMORY", "16g"))
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the settings our semantics depend on (time zone) on any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (spark.checkpoint.dir).

    Only a local master (tests) may have none; then one is made under the system
    temp folder.  Elsewhere an unset folder is an error: executors and driver
    would each write to a disk of their own.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="pantry-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df):
    """Reliable (not local) checkpoint: survives executor loss, bounds lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
