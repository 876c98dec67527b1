"""Session settings and the shared work folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; the cluster's own values come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``. Where it is unset, as in tests, a local master gets a
    folder of its own; on a cluster that is an error, because other machines would not see it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    """One folder for each process: a running session does not take the setting any more."""
    return tempfile.mkdtemp(prefix="tidemark-")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, for a table written and read back."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
