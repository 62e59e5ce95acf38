"""The folder for tables written to cut lineage, visible to every executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own, removed
    at exit. On a cluster a missing setting is an error, because a folder of one
    machine would be invisible to the executors.
    """
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="feira-")
        atexit.register(shutil.rmtree, _own_folder, ignore_errors=True)
    return _own_folder
