"""Stored tables under names in the session catalog.

Each name is an external Parquet table whose partitions are listed in the
catalog with the folder that holds them: the published run of a day, or a
bucket of a dimension's newest version. SQL text over ``database.table`` then
prunes days from metadata, and no folder is listed that the query does not need. Publishing
a day or a version moves partitions; the files stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from snapmart.sources.tables import published_days, stored_versions, version_buckets, version_path

BUCKET = T.StructField("bucket", T.IntegerType())
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
AT_ONCE = 500  # partitions added by one statement


def _text(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(column: str, value) -> str:
    return f"PARTITION ({column} = {'null' if value == NO_DAY else _text(value)})"


def create_database(spark: SparkSession, database: str, root: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION {_text(root)}")


def create_table(spark: SparkSession, name: str, schema: T.StructType, column: str, path: str) -> None:
    """An external table without partitions yet, unless the name exists."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet PARTITIONED BY ({column}) LOCATION {_text(path)}")


def partitions(spark: SparkSession, name: str) -> list[str]:
    """Partition values of a named table, from the catalog."""
    return [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def place(spark: SparkSession, name: str, column: str, folders: dict[str, str], whole: bool = True) -> None:
    """Let the partitions of a named table be these folders; with ``whole``
    no others stay. Only catalog entries change."""
    known = set(partitions(spark, name))
    new = sorted(set(folders) - known)
    for lo in range(0, len(new), AT_ONCE):
        spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
            f"{_spec(column, v)} LOCATION {_text(folders[v])}" for v in new[lo:lo + AT_ONCE]))
    for v in sorted(known & set(folders)):
        spark.sql(f"ALTER TABLE {name} {_spec(column, v)} SET LOCATION {_text(folders[v])}")
    if whole:
        for v in sorted(known - set(folders)):
            spark.sql(f"ALTER TABLE {name} DROP {_spec(column, v)}")
    spark.catalog.refreshTable(name)


def name_days(spark: SparkSession, name: str, path: str, schema: T.StructType, column: str) -> None:
    """Name a day-partitioned table; days published without rows have no partition."""
    create_table(spark, name, schema, column, path)
    place(spark, name, column, published_days(spark, path, column))


def name_dimension(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    """Name a dimension's newest version, its buckets as partitions (a column ``bucket`` more)."""
    create_table(spark, name, T.StructType([*schema.fields, BUCKET]), BUCKET.name, path)
    versions = stored_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no committed version under {path}")
    listed = version_buckets(spark, path, versions[-1])
    if listed is None:
        folders = {"0": version_path(path, versions[-1])}
    else:
        folders = {str(b): f"{path.rstrip('/')}/{f}" for b, f in listed.folders.items()}
    place(spark, name, BUCKET.name, folders)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, column: str | None = None) -> None:
    """Replace a named table stored in ``buckets`` buckets by ``key``, sorted inside, one file a bucket
    (and day, with ``column``). Tables of one key and number of buckets join
    on it without a shuffle, whatever their size. Meant for keys with few rows each, such as
    a dimension's: a bucket holds all rows of its keys."""
    out = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    if column:
        out = out.partitionBy(column)
    out.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def newest_day(spark: SparkSession, name: str) -> str | None:
    """The newest ``yyyyMMdd`` day of a named table, from the catalog alone."""
    return max((d for d in partitions(spark, name) if d.isdigit()), default=None)
