"""Where a job may keep data that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of its own; a cluster
    must name one, because a machine-local folder dies with its machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if context.getCheckpointDir() is None:
        if not configured and not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="larder-"))
    return configured or context.getCheckpointDir()


def new_run_dir(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/larder/{purpose}-{uuid.uuid4().hex}"
