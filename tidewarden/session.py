"""Session helpers: local builder for tests and benches, shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", partitions: int = 8, app: str = "tidewarden") -> SparkSession:
    """Single-machine session used by the tests and ``bench.py``."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEWARDEN_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_private: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is missing a local master, whose tasks all run in this process, gets
    a private folder per application; a cluster must name one, because a machine-local
    folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _private:
        _private[context.applicationId] = tempfile.mkdtemp(prefix="tidewarden-")
    return _private[context.applicationId]


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never reused between runs."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written_once(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back, for rows that are needed several times."""
    folder = fresh_folder(frame.sparkSession, label)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
