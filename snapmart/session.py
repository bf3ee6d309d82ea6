"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every snapmart session wants. Timestamps are cut to dates in the
# session zone, so the zone is pinned; AQE re-plans joins and coalesces
# shuffle partitions from runtime sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "snapmart",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for written tables: the cluster's checkpoint dir.

    It is read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local-mode session without one gets a fresh
    folder of its own; on a cluster a missing setting is an error, since a
    machine-local folder would not be visible to other executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    d = tempfile.mkdtemp(prefix="snapmart-")
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared work dir for one run."""
    return os.path.join(work_dir(spark), "snapmart", f"{name}-{uuid.uuid4().hex[:12]}")


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files under ``paths`` (a metadata call per path)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for st in fs.globStatus(path) or []:  # plain paths and globs alike
            total += fs.getContentSummary(st.getPath()).getLength()
    return total


def size_shuffle_partitions(spark: SparkSession, *paths: str,
                            bytes_per_partition: int = 128 << 20, minimum: int | None = None) -> int:
    """Set ``spark.sql.shuffle.partitions`` to about one partition per
    ``bytes_per_partition`` of input (never fewer than the cluster's
    parallelism); AQE then coalesces the partitions a stage does not need."""
    floor = minimum or spark.sparkContext.defaultParallelism
    n = max(floor, -(-input_bytes(spark, *paths) // bytes_per_partition))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
