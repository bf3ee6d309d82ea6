"""Intake of landed files: every file is taken in by one day, once.

A ledger lists the files that a day's run has read. It is written, under the
run's own name, before the run's rows; the marker that publishes the rows is what makes the
ledger entries count. A job that fails or a driver that is lost in between leaves both as they were,
and the files are offered again. A rerun of a day is offered the day's
own files again beside what has landed since, as its rows replace the day's.

A file is known by its path. One that was replaced under its old name is not
taken in again, which would double its rows; ``changed`` tells such files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.sources.tables import RUN, current_folders, day_folder, new_run, write_day

LEDGER = "file string, bytes long, modified timestamp, day string"


def landed(spark: SparkSession, *globs: str) -> DataFrame:
    """The files under paths or globs, by Spark's own listing; no file is opened.
    Names that start with ``_`` or ``.`` (half-written uploads) are passed over."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(globs))
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def taken(spark: SparkSession, table: str, ledger: str) -> DataFrame:
    """The ledger: files read by the published run of each day."""
    runs = [f[len(table.rstrip("/")) + 1:] for f in current_folders(spark, table) or [] if f.rsplit("/", 1)[1].startswith(RUN)]
    paths = [f"{ledger.rstrip('/')}/{r}" for r in runs]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = [p for p in paths if (at := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(at)]
    return spark.read.schema(LEDGER).parquet(*found) if found else spark.createDataFrame([], LEDGER)


def offered(spark: SparkSession, globs: list[str], table: str, ledger: str, day) -> DataFrame:
    """Landed files that no other day has taken."""
    others = taken(spark, table, ledger).filter(F.col("day") != F.lit(str(day)))
    return landed(spark, *globs).join(others.select("file"), "file", "left_anti")


def changed(spark: SparkSession, globs: list[str], table: str, ledger: str) -> DataFrame:
    """Files taken in whose size or time is no longer what it was then."""
    then = taken(spark, table, ledger).select("file", "day", F.col("bytes").alias("then_bytes"), F.col("modified").alias("then_modified"))
    return landed(spark, *globs).join(then, "file").filter(
        (F.col("bytes") != F.col("then_bytes")) | (F.col("modified") != F.col("then_modified")))


def take_day(spark: SparkSession, globs: list[str], table: str, ledger: str, column: str, day,
             rows: Callable[[list[str]], DataFrame]) -> list[str]:
    """Read the files offered to a day with ``rows`` (paths to a frame), publish
    them as that day of ``table`` and return the paths. The names of one
    day's files are all that comes to the driver, as for any scan. No file, no rows: the day is published empty."""
    run = new_run()
    mine = offered(spark, globs, table, ledger, day).withColumn("day", F.lit(str(day)))
    target = f"{day_folder(ledger, column, day)}/{RUN}{run}"
    mine.write.parquet(target)
    paths = sorted(r[0] for r in spark.read.schema(LEDGER).parquet(target).select("file").collect())
    write_day(rows(paths), table, column, day, run)
    return paths
