"""Session settings for tests, benchmarks and small runs; clusters bring their own."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_own_dir: str | None = None


def local_session(cores: int | str = "*", app: str = "tablewatch", partitions: int = 8) -> SparkSession:
    """A single-machine session with the settings the tests assume."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # building a plan calls into the JVM thousands of times; call sites would double that
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) a fresh temporary folder is
    used; on a cluster that would be another folder on every machine, so it is an error there.
    """
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="tablewatch-")
    return _own_dir
