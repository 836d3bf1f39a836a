"""Shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder, kept as the checkpoint
    folder of its context; on a cluster a machine-local folder would not be visible to the others.
    """
    context = spark.sparkContext
    root = spark.conf.get(SETTING, None) or context.getConf().get(SETTING) or context.getCheckpointDir()
    if root:
        return root
    # local-cluster has executors of its own.
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError(f"set {SETTING} to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="vigia-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
