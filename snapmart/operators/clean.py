"""Cleaning raw listings into curated rows.

* ``split_allowed``: rows whose key is in an allow-list (clean) and the rest,
  null keys included (corrupt). The two parts partition the input.
* ``profile``: per column, the count of clean rows that are null or hold the
  text ``NULL``, and the count of corrupt rows, in one aggregation pass.
* ``curate_channel`` / ``curate_video``: the curated projections, stamped
  with the run date.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from snapmart.functions import iso_duration, null_or_text_null, split_list, to_date_safe
from snapmart.session import scratch_path

# The allow-list of channel ids used by the original cleaning job.
CHANNEL_ALLOW_LIST = [
    "UC0GP1HDhGZTLih7B89z_cTg",
    "UC4p_I9eiRewn2KoU-nawrDg",
    "UCrbQxu0YkoVWu2dw5b1MzNg",
    "UCs0xZ60FSNxFxHPVFFsXNTA",
    "UC_WgSFSkn7112rmJQcHSUIQ",
]


def allowed(column: str, ids: Iterable) -> Column:
    """True for a key in the list; false or null (null key) otherwise."""
    return F.col(column).isin(list(ids))


def split_allowed(df: DataFrame, column: str, ids) -> tuple[DataFrame, DataFrame]:
    """(clean, corrupt). ``ids`` is a list (an ``isin`` predicate, evaluated
    in the scan's codegen stage) or a DataFrame with a column named like
    ``column``. A table is joined as it is (semi and anti joins repeat no
    row): both inputs are then plain shuffle reads, so AQE splits a key that
    holds very many rows; rows without a key take no part in the joins."""
    if isinstance(ids, DataFrame):
        keys = ids.select(column).filter(F.col(column).isNotNull())
        keyed, unkeyed = df.filter(F.col(column).isNotNull()), df.filter(F.col(column).isNull())
        return keyed.join(keys, column, "left_semi"), keyed.join(keys, column, "left_anti").unionByName(unkeyed)
    ok = allowed(column, ids)
    return df.filter(ok), df.filter(~F.coalesce(ok, F.lit(False)))


def label_allowed(df: DataFrame, column: str, ids, label: str = "part") -> DataFrame:
    """Both parts of the split in one pass: ``label`` is 'clean' or 'corrupt'."""
    df, ok = flag_allowed(df, column, ids)
    return df.select(F.when(ok, F.lit("clean")).otherwise(F.lit("corrupt")).alias(label),
                     *[c for c in df.columns if c != "_allowed"])


def flag_allowed(df: DataFrame, column: str, ids) -> tuple[DataFrame, Column]:
    """``df`` with a never-null boolean telling clean rows, in one pass over
    ``df``. A DataFrame allow-list is reduced to its distinct keys and stored
    first: its size is then known to the planner, and in a shuffled join both
    inputs are plain reads, so AQE splits a hot key and the null keys."""
    if isinstance(ids, DataFrame):
        path = scratch_path(df.sparkSession, "allow_list")
        ids.select(column).filter(F.col(column).isNotNull()).distinct().write.parquet(path)
        keys = df.sparkSession.read.schema(ids.select(column).schema).parquet(path).withColumn("_allowed", F.lit(True))
        return df.join(keys, column, "left"), F.coalesce(F.col("_allowed"), F.lit(False))
    return df, F.coalesce(allowed(column, ids), F.lit(False))


def profile_exprs(columns: list[str], ok: Column) -> list[Column]:
    """The profile as aggregate expressions (for ``agg`` or ``observe``)."""
    return ([F.count_if(ok & null_or_text_null(c)).alias(c) for c in columns]
            + [F.count_if(~ok).alias("corrupt_records")])


def profile(df: DataFrame, column: str, ids, columns: list[str] | None = None) -> DataFrame:
    """One row: for every column, the number of clean rows that are null or
    contain ``NULL``; plus ``corrupt_records``, the rows outside the list.
    One scan and one global aggregation (partial per task)."""
    cols = columns or df.columns
    df, ok = flag_allowed(df, column, ids)
    return df.agg(*profile_exprs(cols, ok))


def curate_video_profiled(raw: DataFrame, column: str, ids, as_of: dt.date,
                          observation: Observation) -> DataFrame:
    """Curated clean video rows, with the profile of the whole raw listing
    gathered as observed metrics while those rows are produced: one pass over
    the raw file serves both the curated write and the profile
    (``observation.get`` after the write). The metrics are taken in the same
    stage as the rows that feed the write, so each task counts once."""
    cols = raw.columns
    flagged, ok = flag_allowed(raw, column, ids)
    observed = flagged.observe(observation, *profile_exprs(cols, ok))
    return curate_video(observed.filter(ok).select(*cols), as_of)


def curate_channel(raw: DataFrame, as_of: dt.date) -> DataFrame:
    """Raw channel rows to the 10 curated columns; published_at may be a
    timestamp (CSV) or text (flattened JSON), bad text gives a null date."""
    return raw.select(
        "channel_id", "title", "description",
        to_date_safe("published_at").alias("published_date"),
        "default_language", "country", "views_count", "subscribers_count", "videos_count",
        F.lit(as_of).cast("date").alias("updated_date"),
    )


def curate_video(raw: DataFrame, as_of: dt.date) -> DataFrame:
    """Raw video rows to the 20 curated columns: date from the text as
    written, comma hashtags to an array, ISO durations to int parts."""
    return raw.select(
        "video_id", "channel_id",
        to_date_safe("published_at").alias("published_date"),
        "title", "description",
        split_list("hashtags").alias("hashtags"),
        "audio_language",
        *iso_duration("content_duration"),
        "virtual_dimension", "quality_definition", "privacy_status", "topic_category",
        "views_count", "likes_count", "dislikes_count", "favorites_count", "comments_count",
        F.lit(as_of).cast("date").alias("updated_date"),
    )
