"""Daily fact snapshots.

A snapshot is the day's curated rows projected to the fact columns and
stamped with the day's ``yyyyMMdd`` key. It is written into its own
``snapshot_date`` partition, so writing the same day twice leaves one copy.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions import datekey
from snapmart.schemas import CHANNEL_FACT_COLUMNS, VIDEO_FACT_COLUMNS
from snapmart.sources.tables import (
    day_folder, partition_values, published, read_partition, read_table, write_day, write_days,
)

SNAPSHOT = "snapshot_date"


def snapshot_key(as_of: dt.date):
    """The day's key, computed from the date (no lookup in the date
    dimension, so any day has one); a constant folded into the plan."""
    return datekey(F.lit(as_of).cast("date"))


def snapshot(curated: DataFrame, columns: list[str], as_of: dt.date) -> DataFrame:
    return curated.select(*columns, snapshot_key(as_of).alias(SNAPSHOT))


def video_snapshot(curated_video: DataFrame, as_of: dt.date) -> DataFrame:
    return snapshot(curated_video, VIDEO_FACT_COLUMNS[:-1], as_of)


def channel_snapshot(curated_channel: DataFrame, as_of: dt.date) -> DataFrame:
    return snapshot(curated_channel, CHANNEL_FACT_COLUMNS[:-1], as_of)


def write_snapshot(df: DataFrame, path: str, rebalance: bool = False) -> None:
    """Replace the snapshot days present in ``df``; other days stay.
    ``rebalance`` for a backfill of many days (see ``write_days``)."""
    write_days(df, path, SNAPSHOT, rebalance)


def write_snapshot_day(df: DataFrame, path: str, as_of: dt.date) -> None:
    """Replace the snapshot of one day, also by nothing, once the job has committed."""
    write_day(df, path, SNAPSHOT, as_of.strftime("%Y%m%d"))


def read_snapshots(spark: SparkSession, path: str, schema) -> DataFrame:
    return read_table(spark, path, schema)


def latest_day(spark: SparkSession, path: str) -> str:
    """The newest stored snapshot day that has rows, from folder and marker
    names on the driver. ``yyyyMMdd`` keys order as text. A day published
    without rows is passed over, as the maximum over the rows passes it over."""
    # a null key is stored as a default-partition folder: never the newest day
    days = [d for d in partition_values(spark, path, SNAPSHOT) if d.isdigit() and len(d) == 8]
    seen = False
    for day in reversed(days):
        folder, rows = published(spark, day_folder(path, SNAPSHOT, day))
        if rows:
            return day
        seen = seen or folder is not None
    if seen:
        return max(days)  # no day has rows
    raise FileNotFoundError(f"no snapshot under {path}")


def read_latest_snapshot(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest stored snapshot day that has rows (none of them: no rows).
    With years of daily partitions (and many files each) no job scans every
    file to find the max; only that day's files are read."""
    return read_partition(spark, path, schema, SNAPSHOT, latest_day(spark, path))
