"""Folders that the driver and every executor see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_folder: dict[str, str] = {}


def shared_base(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Without that setting only a session whose executors are the driver itself (``local[...]``)
    gets a folder of its own; on a cluster it is an error, as a local folder would differ from
    machine to machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_folder:
            _local_folder[app] = tempfile.mkdtemp(prefix="millrace-")
        base = _local_folder[app]
    return base.rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder (nothing is created)."""
    return f"{shared_base(spark)}/{purpose}-{uuid.uuid4().hex}"
