"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings a cluster job should start with. Shuffle partitions are set high and
# left to adaptive execution to merge, so one value serves small and large runs.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # CSV in an encoding beyond the standard few, such as cp949.
    "spark.sql.legacy.javaCharsets": "true",
}


def build_session(app: str = "roadevents", **settings: str) -> SparkSession:
    """A session with the defaults above; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path that every executor can reach.

    The base is ``spark.checkpoint.dir``, or the session's warehouse folder where that
    is unset: both lie on the session's own file system.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/roadevents/{purpose}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    """A path and its file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI with the scheme of the cluster's file system, as Arrow reads it."""
    hadoop_path, fs = _located(spark, path)
    uri = fs.makeQualified(hadoop_path).toString()
    return uri.replace("file:/", "file:///", 1) if not uri.startswith("file:///") else uri


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a folder; False if there is none. The target must not exist."""
    (old, fs), (new, _) = _located(spark, source), _located(spark, target)
    if not fs.exists(old):
        return False
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if there is one."""
    hadoop_path, fs = _located(spark, path)
    fs.delete(hadoop_path, True)


def path_has_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system and holds anything."""
    hadoop_path, fs = _located(spark, path)
    return fs.exists(hadoop_path) and len(fs.listStatus(hadoop_path)) > 0


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder in order; none if there is no folder."""
    hadoop_path, fs = _located(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))
