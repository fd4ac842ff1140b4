"""Session settings the engine relies on, and its shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Generated methods beyond this size are never compiled by the JVM; without the
    # limit a wide cleaning projection would run interpreted, at half the speed.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's settings; a cluster gives its own master and sizes."""
    builder = SparkSession.builder.appName("tillstar")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (`spark.checkpoint.dir`).

    Only a local session may do without the setting; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    one_process = master == "local" or master.startswith("local[")  # local-cluster has executors of its own
    if configured:
        return configured
    if not one_process:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="tillstar-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tillstar/{label}-{uuid.uuid4().hex}"
