"""Dimensions: the date dimension and type-1 (overwrite) merges.

Type-1 merge semantics (as a Delta ``MERGE`` with update-set and insert-values):

* matched row: the update columns take the source value, null included;
  every other column keeps the target value;
* source row without match: inserted with the insert columns (others null);
* target row without match: kept;
* a null key never matches: such source rows are inserted, such target
  rows kept;
* two source rows for one matched target row are an error
  (``on_duplicate="error"``), or the newest wins (``"latest"``).

Plan: see ``scd1_merge``. Null keys take no part in a join, repeated source
keys are reduced by partial aggregations before a shuffle, and the joins'
inputs are plain shuffle reads, so AQE splits a key that holds very many rows.
The duplicate guard fails inside the job (nothing is collected).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions import datekey, month_name
from snapmart.schemas import comparable_columns
from snapmart.session import scratch_path
from snapmart.sources.tables import (
    Buckets, bucket_of, read_folders, read_latest_version, stored_versions, version_buckets, version_key, write_buckets,
)


# ---- date dimension --------------------------------------------------------

# The default range of the date dimension generator.
DATE_DIM_START = dt.date(2010, 1, 1)
DATE_DIM_END = dt.date(2024, 12, 31)

def date_attributes(d: Column) -> list[Column]:
    """The date dimension's columns for a date column."""
    wd = F.weekday(d)  # Monday = 0
    return [
        d.alias("date"),
        F.dayofmonth(d).alias("day"), F.month(d).alias("month"), F.year(d).alias("year"),
        (wd + 1).alias("day_of_week"),            # ISO: Monday = 1 ... Sunday = 7
        F.weekofyear(d).alias("week_of_year"),    # ISO week
        F.quarter(d).alias("quarter"),
        (wd >= 5).cast("int").alias("is_weekend"),
        F.date_format(d, "EEEE").alias("day_name"),
        month_name(d).alias("month_name"),
        F.dayofyear(d).alias("day_of_year"),
        datekey(d).alias("datekey"),
    ]


def date_dim(spark: SparkSession, start: dt.date = DATE_DIM_START,
             end: dt.date = DATE_DIM_END) -> DataFrame:
    """One row per day of ``[start, end]``, generated in parallel by
    ``spark.range`` (no driver-side list of rows)."""
    n = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(0, max(n, 0)).select(*date_attributes(d))


def date_dim_covering(df: DataFrame, column: str) -> DataFrame:
    """Date dimension spanning the min..max date of a column: one global
    min/max aggregation, then one row per day of that span."""
    span = df.agg(F.min(F.to_date(column)).alias("s"), F.max(F.to_date(column)).alias("e"))
    days = span.select(F.explode(F.sequence("s", "e", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*date_attributes(F.col("d")))


def write_date_dim(df: DataFrame, path: str) -> None:
    """Store the date dimension as Parquet partitioned by year and month,
    replacing the whole table (a narrower range leaves no old months)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static")
       .partitionBy("year", "month").parquet(path))


# ---- type-1 merge ----------------------------------------------------------

BUCKETS = 16  # of a dimension; about its bytes / 128 MB where it is larger

def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count (partial counts
    per task first, so a hot key costs one row per task in the shuffle)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_count"))
            .filter(F.col("key_count") > 1))


def _all_keys_set(keys) -> Column:
    c = F.lit(True)
    for k in keys:
        c = c & F.col(k).isNotNull()
    return c


def latest_per_key(source: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    """One row per key: the row with the largest ``newest_by`` values (a null
    counts as oldest), ties going to the largest remaining values, so every
    task attempt picks the same row. A ``max_by`` aggregation: each task
    first keeps its best row per key, so a key holding a third of all rows
    sends one row per task to the shuffle."""
    rest = [c for c in comparable_columns(source.schema) if c not in newest_by]
    order = F.struct(*[F.col(c) for c in list(newest_by) + rest])
    best = F.max_by(F.struct(*[F.col(c) for c in source.columns]), order)
    return source.groupBy(*keys).agg(best.alias("_r")).select("_r.*")


def scd1_merge(target: DataFrame, source: DataFrame, keys: list[str], update: list[str],
               insert: list[str] | None = None, on_duplicate: str = "error",
               newest_by: list[str] | None = None) -> DataFrame:
    """The target after a type-1 merge of the source (see module doc).

    ``update``: columns overwritten on a match; ``insert``: columns written
    for a new row (default: all target columns). With
    ``on_duplicate="latest"``, repeated source keys keep the row with the
    largest ``newest_by`` values (default ``["updated_date"]``).

    Plan, safe for a key that holds a third of all rows on either side:

    * rows with a null key never match: on both sides they are split off (a
      filter, pushed into the scan) and kept or inserted as they are;
    * the source is reduced to one row per key (``latest``: a ``max_by``;
      ``error``: any row and the count), partially aggregated before its
      shuffle, and stored under the work folder. Its size is then known, so
      Spark broadcasts it where it is small, and otherwise both join inputs
      are plain shuffle reads, whose skewed partitions AQE can split;
    * matched and kept rows: target left join the stored rows. A source key
      with several rows fails the job in flight once it matches;
    * inserted rows: source left anti join the target's keys.

    A matched row takes the source's value even when it is null.
    """
    if on_duplicate not in ("error", "latest"):
        raise ValueError("on_duplicate must be 'error' or 'latest'")
    columns = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    insert = list(insert or columns)
    update_cols = [c for c in columns if c in update and c not in keys]
    has_key = _all_keys_set(keys)
    src_ok, src_null = source.filter(has_key), source.filter(~has_key)

    if on_duplicate == "latest":
        one = latest_per_key(src_ok, keys, ["updated_date"] if newest_by is None else newest_by)
        rows_in, one = None, one.withColumn("_n", F.lit(1).cast("bigint"))
    else:
        whole = F.struct(*[F.col(c) for c in source.columns])
        one = src_ok.groupBy(*keys).agg(F.first(whole).alias("_r"), F.count(F.lit(1)).alias("_n"))
        rows_in, one = src_ok, one.select("_r.*", "_n")
    one = _stored(one)
    rows_in = one if rows_in is None else rows_in

    s = one.select(*[F.col(k).cast(types[k]).alias(f"_k_{k}") for k in keys],
                   *[F.col(c).cast(types[c]).alias(f"_s_{c}") for c in update_cols], "_n")
    t = target.filter(has_key)
    j = t.join(s, [t[k] == s[f"_k_{k}"] for k in keys], "left")
    matched = F.col("_n").isNotNull()
    j = j.filter(F.when(F.col("_n") > 1, F.raise_error(F.lit(
        "merge: several source rows match one target row; "
        "deduplicate the source or use on_duplicate='latest'"))).otherwise(F.lit(True)))
    kept = j.select(*[(F.when(matched, F.col(f"_s_{c}")).otherwise(t[c]) if c in update_cols else t[c]).alias(c)
                      for c in columns])

    known = target.filter(has_key).select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    new = rows_in.join(known, [rows_in[k].cast(types[k]) == known[f"_t_{k}"] for k in keys], "left_anti")

    def inserted(df: DataFrame) -> DataFrame:
        return df.select(*[(F.col(c).cast(types[c]) if c in insert or c in keys else F.lit(None).cast(types[c])).alias(c)
                           for c in columns])
    return (kept.unionByName(inserted(new)).unionByName(inserted(src_null))
            .unionByName(target.filter(~has_key)))


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "merge_source")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_dimension(spark: SparkSession, path: str, source: DataFrame, schema: T.StructType,
                   keys: list[str], update: list[str], insert: list[str] | None,
                   as_of: dt.date, on_duplicate: str = "error", buckets: int = BUCKETS) -> DataFrame:
    """Merge ``source`` into the dimension stored at ``path`` as of a day and
    return the version written.

    The newest version older than ``as_of`` is the merge target; the result
    is stored as version ``as_of`` (a rerun of the same day replaces it and
    never reads it). Without an older version this is the first load: a
    merge into an empty target, so ``on_duplicate`` applies to it too.
    Versions are snapshots: backfilling a day older than the newest version
    means running the later days again, in order.

    Rows are stored in ``buckets`` buckets by a hash of the keys (the number is
    fixed by the first load). A key can only meet rows of its own bucket, so
    the merge reads and writes the buckets that hold a key of the source; the
    new version names the other buckets' files as they are. The bucket numbers
    (at most ``buckets``) are all that comes to the driver.
    """
    v = version_key(as_of)
    columns = [f.name for f in schema.fields]
    src = source.select(*[F.col(c).cast(f.dataType) for c, f in zip(columns, schema.fields)])
    below = [x for x in stored_versions(spark, path) if x < v]
    older = version_buckets(spark, path, below[-1]) if below else None
    if below and older is None:  # a version of whole files: all its rows go into buckets
        older = Buckets(buckets, {})
        target = read_latest_version(spark, path, schema, below=v)
    else:
        older = older or Buckets(buckets, {})
        touched = [r[0] for r in src.select(bucket_of(keys, older.count)).distinct().collect()]
        paths = Buckets(older.count, {b: older.folders[b] for b in touched if b in older.folders}).paths(path)
        target = read_folders(spark, schema, paths)
    if below or on_duplicate == "latest":
        result = scd1_merge(target, src, keys, update, insert, on_duplicate)
    else:
        # into an empty dimension nothing matches, so nothing can fail: every
        # row is inserted with the insert columns (a plain projection)
        keep = set(insert or columns)
        result = src.select(*[F.col(c) if c in keep else F.lit(None).cast(f.dataType).alias(c)
                              for c, f in zip(columns, schema.fields)])
    return read_folders(spark, schema, write_buckets(result, path, v, keys, older).paths(path))
