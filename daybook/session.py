"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a long-running cluster session should have. AQE merges shuffle partitions but never adds any, so a cluster
# sets spark.sql.adaptive.coalescePartitions.initialPartitionNum to what its largest run needs.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def scratch_folder(spark: SparkSession) -> str:
    """The folder all executors share for short-lived data: the one the session names in ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder of its own; a cluster must name one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="daybook-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_folder(spark)}/daybook/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def make_folder(spark: SparkSession, path: str) -> bool:
    """Create a folder unless it is there; whether it was created."""
    system, hadoop_path = _file_system(spark, path)
    return not system.exists(hadoop_path) and system.mkdirs(hadoop_path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library created, through the file system that owns it."""
    system, hadoop_path = _file_system(spark, path)
    system.delete(hadoop_path, True)


def matching_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, last changed first."""
    system, hadoop_path = _file_system(spark, pattern)
    found = [(status.getModificationTime(), status.getPath().toString()) for status in system.globStatus(hadoop_path) or []]
    return [path for _, path in sorted(found, reverse=True)]


def write_scratch(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write rows once to the shared scratch folder; the rows as read from there, and their path.

    Later steps start from files: a costly plan is not computed again, sizes are known for join planning, and a lost
    executor costs no more than a re-read.
    """
    path = new_scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str):
    """Set one session option for the duration of a write and put the old value back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
