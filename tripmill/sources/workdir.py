"""A fresh directory for intermediate tables, in storage every executor reaches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from tripmill.sources.tables import delete_path


_made: list[str] = []


def new_workdir(spark: SparkSession, purpose: str) -> str:
    """A new path below the cluster's checkpoint folder; machine-local only in local mode.

    Results are read from it lazily, so it stays until `delete_workdirs`.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="tripmill-")
    path = f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def delete_workdirs(spark: SparkSession) -> None:
    """Deletes what `new_workdir` has handed out, once nothing reads it any more."""
    while _made:
        delete_path(spark, _made.pop())
