"""Session helper and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitter's session is used instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName("macrospark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")  # in local mode the driver does all the work
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a folder of this machine: on a
    cluster a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(context.applicationId)


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    folder = tempfile.mkdtemp(prefix=f"macrospark-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # nothing in it outlives the process
    return folder


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/macrospark/{label}-{uuid.uuid4().hex}"
