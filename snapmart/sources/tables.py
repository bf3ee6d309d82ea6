"""Columnar tables: day-partitioned Parquet and versioned dimensions.

* Curated and fact tables are partitioned by a day column; a write replaces
  its day, also by nothing, so a rerun of the same day gives the same table
  instead of doubling it. Each run writes its own folder inside the day's; a
  marker beside it, made by the driver once the job has committed, names the
  run that readers take. A job that fails, or a driver that is lost, before
  that leaves the day as it was.
* A dimension's versions are ``version=<n>`` folders; readers take the highest
  committed one. A version either holds its files, or is a list of bucket
  folders: rows lie in buckets by a hash of their key, a version writes the
  buckets it changes and names the others where an older version left them.
  No version overwrites what another one names.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "version"
COMMITTED = "_COMMITTED"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet with an explicit schema, partition columns included; a
    ``yyyyMMdd`` partition value then stays a string. Of days that were
    published run by run, the published runs are read."""
    folders = current_folders(spark, path)
    if folders is None:
        return spark.read.schema(schema).parquet(path)
    return _read_folders(spark, path, schema, folders)


def _read_folders(spark: SparkSession, path: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def day_filter(column: str, as_of) -> Column:
    return F.col(column) == F.lit(as_of)


def day_folder(path: str, column: str, day) -> str:
    return f"{path.rstrip('/')}/{column}={day}"


def read_day(spark: SparkSession, path: str, schema: T.StructType, as_of,
             column: str = "updated_date") -> DataFrame:
    """One day of a day-partitioned table: its published run, or, of a day
    without runs, its files (the filter prunes partitions)."""
    folder, _ = published(spark, day_folder(path, column, as_of))
    if folder is None and current_folders(spark, path) is None:
        return spark.read.schema(schema).parquet(path).filter(day_filter(column, as_of))
    return _read_folders(spark, path, schema, [folder] if folder else [])


# ---- published days ---------------------------------------------------------

PUBLISHED, RUN = "_current-", "run-"


def _marker(name: str) -> tuple[int, str, bool]:
    """(sequence number, run, whether it has rows) of a marker's file name."""
    seq, run, rows = name[len(PUBLISHED):].split("-")
    return int(seq), run, rows == "rows"


def _newest(folder: str, names: list[str]) -> tuple[str | None, bool]:
    markers = [_marker(n) for n in names if n.startswith(PUBLISHED)]
    if markers:
        _, run, rows = max(markers)
        return f"{folder}/{RUN}{run}", rows
    if any(n[0] not in "_." and not n.startswith(RUN) for n in names):
        return folder, True  # written by ``write_days``
    return None, False


def published(spark: SparkSession, folder: str) -> tuple[str | None, bool]:
    """The folder that readers of a day take, None before its first run is
    published, and whether it holds rows. One listing on the driver."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return None, False
    return _newest(folder, [st.getPath().getName() for st in fs.listStatus(p)])


def current_folders(spark: SparkSession, path: str) -> list[str] | None:
    """The folders that readers of all days take; None for a table without runs
    (plain Parquet). Listings on the driver, no data read."""
    days = _names_by_day(spark, path, "*")
    if not any(n.startswith((PUBLISHED, RUN)) for names in days.values() for n in names):
        return None
    found = (_newest(f"{path.rstrip('/')}/{day}", names)[0] for day, names in sorted(days.items()))
    return [f for f in found if f]


def _names_by_day(spark: SparkSession, path: str, column: str) -> dict[str, list[str]]:
    fs, p = _fs(spark, path)
    days: dict[str, list[str]] = {}
    for st in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, f"{column}=*/*")) or []:
        days.setdefault(st.getPath().getParent().getName(), []).append(st.getPath().getName())
    return days


def published_days(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """The folder that readers take of each day that has rows."""
    found = {day.split("=", 1)[1]: _newest(day_folder(path, *day.split("=", 1)), names)
             for day, names in _names_by_day(spark, path, column).items()}
    return {day: folder for day, (folder, rows) in sorted(found.items()) if rows}


def publish(spark: SparkSession, folder: str, run: str, rows: bool) -> None:
    """Make a written run of a day the one that readers take: one file is
    created, the rest of the day stays as it is."""
    fs, p = _fs(spark, folder)
    seqs = [_marker(st.getPath().getName())[0] for st in fs.listStatus(p) if st.getPath().getName().startswith(PUBLISHED)]
    name = f"{PUBLISHED}{max(seqs, default=0) + 1:09d}-{run}-{'rows' if rows else 'none'}"
    fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, name), False).close()


def new_run() -> str:
    return uuid.uuid4().hex[:12]


def write_day(df: DataFrame, path: str, column: str, day, run: str | None = None) -> str:
    """Replace one known day, also by nothing, and return the folder written.

    The rows go to a folder of their own, which readers ignore until it is
    published; a failed job changes nothing they see. Runs published before stay for readers that
    have planned with them until ``expire_runs``. ``column`` is implied by the
    folder."""
    folder, run = day_folder(path, column, day), run or new_run()
    target, rows = f"{folder}/{RUN}{run}", df.drop(column)
    rows.write.parquet(target)
    spark = df.sparkSession
    publish(spark, folder, run, not spark.read.schema(rows.schema).parquet(target).isEmpty())
    return target


def expire_runs(spark: SparkSession, path: str, column: str, day) -> list[str]:
    """Delete a day's runs other than the published one, with their markers
    (and files that an earlier ``write_days`` left), and return what went.
    Not called by the daily run: a reader may still hold a run."""
    folder = day_folder(path, column, day)
    fs, p = _fs(spark, folder)
    keep = (published(spark, folder)[0] or "").rsplit(RUN, 1)
    if len(keep) < 2:
        return []
    gone = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if keep[1] not in name:
            fs.delete(st.getPath(), True)
            gone.append(name)
    return sorted(gone)


def write_days(df: DataFrame, path: str, partition_cols, rebalance: bool = False) -> None:
    """Write, replacing only the partitions present in ``df``.

    Each task writes one file per partition it holds, which is right for a
    daily write (one day). ``rebalance=True``, for a backfill of many days at
    once, first gathers the rows of each day; Spark then cuts a large day into
    tasks of the advisory partition size and merges small ones, so the number
    of files follows the bytes of a day.
    """
    cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    if rebalance:
        df = df.hint("rebalance", *cols)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*cols).parquet(path))


def version_key(as_of: dt.date | str) -> int:
    return int(str(as_of).replace("-", ""))


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{VERSION}={int(version)}"


def write_version(df: DataFrame, path: str, version: int, **options) -> None:
    """Store a whole new version of a table in its own folder beside the
    older ones, then mark it committed. The marker is written by the driver
    after the write job has committed, so a write cut short (lost executor
    or driver) is never read: readers fall back to the newest committed
    version. (Spark's own ``_SUCCESS`` file can be switched off on a
    cluster, so it is not relied on.)"""
    target = version_path(path, version)
    df.write.mode("overwrite").options(**options).parquet(target)
    fs, p = _fs(df.sparkSession, target)
    fs.create(df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(p, COMMITTED), True).close()


def write_clustered(df: DataFrame, path: str, version: int, by: list[str], key: str,
                    row_group: int = 32 << 20) -> None:
    """Store a version laid out by ``by``: rows are dealt by ranges of (by, key)
    and sorted inside, so the files and row groups of one value of ``by`` are few and
    neighbours, and the minima and maxima in the footers rule the others out.
    The key is part of the range, so a value that holds a third of all rows is dealt to many tasks;
    files follow bytes, not the number of values. A bloom filter on ``key``
    rules out row groups for a lookup by key, which the layout does not order."""
    laid = df.repartitionByRange(*by, key).sortWithinPartitions(*by, key)
    write_version(laid, path, version, **{
        f"parquet.bloom.filter.enabled#{key}": "true", "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.block.size": str(row_group)})


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a row; rows with a null in a key have one, too."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


LISTED = "_buckets-"


@dataclass(frozen=True)
class Buckets:
    """A version's buckets: how many there may be, and the folder (below the
    table's) of each one that holds rows."""
    count: int
    folders: dict[int, str]

    def paths(self, path: str) -> list[str]:
        return [f"{path.rstrip('/')}/{f}" for _, f in sorted(self.folders.items())]


def version_buckets(spark: SparkSession, path: str, version: int) -> Buckets | None:
    """The newest complete bucket list of a version, if it has one: a few bytes
    read on the driver for each bucket."""
    fs, p = _fs(spark, version_path(path, version))
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    for name in sorted((st.getPath().getName() for st in fs.listStatus(p) if st.getPath().getName().startswith(LISTED)), reverse=True):
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(p, name))
        try:
            lines = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("\n")
        finally:
            stream.close()
        if lines[-1] == "end":  # otherwise the driver was lost while it wrote the list
            pairs = (line.split(" ", 1) for line in lines[1:-1])
            return Buckets(int(lines[0]), {int(b): f for b, f in pairs})
    return None


def write_buckets(df: DataFrame, path: str, version: int, keys: list[str], older: Buckets) -> Buckets:
    """Store a version whose rows in ``df`` replace the buckets they fall in,
    while all other buckets stay the files of ``older``. The rows of a bucket
    are gathered, and a large bucket is cut by Spark, so files follow bytes.
    The list is written by the driver after the job has committed."""
    spark = df.sparkSession
    run = f"{VERSION}={int(version)}/{RUN}{uuid.uuid4().hex[:12]}"
    target = f"{path.rstrip('/')}/{run}"
    (df.withColumn("bucket", bucket_of(keys, older.count)).hint("rebalance", "bucket")
       .write.partitionBy("bucket").parquet(target))
    written = {int(b): f"{run}/bucket={b}" for b in partition_values(spark, target, "bucket")}
    merged = Buckets(older.count, {**older.folders, **written})
    fs, p = _fs(spark, version_path(path, version))
    seqs = [int(st.getPath().getName()[len(LISTED):]) for st in fs.listStatus(p) if st.getPath().getName().startswith(LISTED)]
    text = "\n".join([str(merged.count), *(f"{b} {f}" for b, f in sorted(merged.folders.items())), "end"])
    out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, f"{LISTED}{max(seqs, default=0) + 1:09d}"), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return merged


def read_folders(spark: SparkSession, schema: T.StructType, folders: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def version_folders(spark: SparkSession, path: str, version: int) -> list[str]:
    """The folders that hold a committed version's files."""
    listed = version_buckets(spark, path, version)
    return listed.paths(path) if listed else [version_path(path, version)]


def read_version(spark: SparkSession, path: str, schema: T.StructType, version: int) -> DataFrame:
    return read_folders(spark, schema, version_folders(spark, path, version))


def read_latest_version(spark: SparkSession, path: str, schema: T.StructType,
                        below: int | None = None) -> DataFrame:
    """The newest committed version (older than ``below`` when given, so that
    a same-day rerun merges against the previous day and never reads the
    folder it replaces). Picking it is a folder listing on the driver; the
    scan then reads only that version's files."""
    versions = [v for v in stored_versions(spark, path) if below is None or v < int(below)]
    if not versions:
        raise FileNotFoundError(f"no committed version under {path}")
    return read_version(spark, path, schema, max(versions))


def stored_versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions under ``path`` (folders with the commit marker or a
    complete bucket list; listings on the driver, no data read)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    jvm = spark.sparkContext._jvm
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION + "="):
            v = int(name.split("=", 1)[1])
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), COMMITTED)) or version_buckets(spark, path, v):
                out.append(v)
    return sorted(out)


def expire_versions(spark: SparkSession, path: str, keep: int = 7) -> list[int]:
    """Delete all but the newest ``keep`` committed versions and return those
    deleted. Bucket folders that a kept version names stay. Not called by the
    daily run: a reader may still hold a version."""
    versions = stored_versions(spark, path)
    old = versions[:-keep] if keep > 0 else []
    lists = (version_buckets(spark, path, v) for v in versions[len(old):])
    named = {f for listed in lists if listed for f in listed.folders.values()}
    jvm = spark.sparkContext._jvm
    for v in old:
        fs, p = _fs(spark, version_path(path, v))
        if not any(n.startswith(f"{VERSION}={v}/") for n in named):
            fs.delete(p, True)
            continue
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if not name.startswith(RUN):  # first of all the marker or list: from here on it is no version
                fs.delete(st.getPath(), True)
        for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(p, f"{RUN}*/*")):
            at = st.getPath()
            if f"{VERSION}={v}/{at.getParent().getName()}/{at.getName()}" not in named:
                fs.delete(at, True)
    return old


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a top-level partition column, from the folder names only
    (``column=value``); no file is opened. A value may have no published run
    yet (see ``published``)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    prefix = column + "="
    return sorted(st.getPath().getName()[len(prefix):] for st in fs.listStatus(p)
                  if st.isDirectory() and st.getPath().getName().startswith(prefix))


def read_partition(spark: SparkSession, path: str, schema: T.StructType, column: str,
                   value: str) -> DataFrame:
    """One partition's published folder, keeping the partition column (``basePath``)."""
    folder, _ = published(spark, day_folder(path, column, value))
    return _read_folders(spark, path, schema, [folder] if folder else [])
