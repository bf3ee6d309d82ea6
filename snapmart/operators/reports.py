"""Report queries over the dimensions and fact snapshots.

Every report takes DataFrames (so it runs the same over stored tables or
derived ones) and returns a lazy DataFrame; sorting is explicit about
nulls (nulls last, in both directions).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import month_name_of, quarter_label, safe_ratio

SNAPSHOT = "snapshot_date"


def latest(fact: DataFrame, column: str = SNAPSHOT) -> DataFrame:
    """Rows of the newest snapshot.

    ``column = (select max(column) from fact)`` as a scalar subquery: over a
    stored, partitioned fact the max reads no data columns and the filter
    prunes partitions; over a derived fact Catalyst drops the grouping under
    the max and pushes the filter below the aggregation's shuffle.
    """
    return fact.filter(F.col(column) == fact.select(F.max(column)).scalar())


def channel_metric(channel_dim: DataFrame, channel_fact: DataFrame, metric: str) -> DataFrame:
    """Channel id, title and one count of the newest snapshot (inner join)."""
    f = latest(channel_fact).select("channel_id", metric)
    d = channel_dim.select("channel_id", "title")
    return d.join(f, "channel_id").select("channel_id", "title", metric)


def channel_video_counts(channel_dim: DataFrame, channel_fact: DataFrame) -> DataFrame:
    return channel_metric(channel_dim, channel_fact, "videos_count")


def channel_subscriber_counts(channel_dim: DataFrame, channel_fact: DataFrame) -> DataFrame:
    return channel_metric(channel_dim, channel_fact, "subscribers_count")


def engagement_ratio(video_dim: DataFrame, video_fact: DataFrame) -> DataFrame:
    """Likes and comments per view for every video of the newest snapshot,
    highest like ratio first; zero or null views give a null ratio, sorted last."""
    f = latest(video_fact).select("video_id", "views_count", "likes_count",
                                  "dislikes_count", "comments_count")
    d = video_dim.select("video_id", "title", "channel_id", "published_date")
    return (d.join(f, "video_id")
            .select("video_id", "title", "channel_id", "published_date",
                    "views_count", "likes_count", "dislikes_count",
                    safe_ratio("likes_count", "views_count").alias("like_to_view_ratio"),
                    safe_ratio("comments_count", "views_count").alias("comment_to_view_ratio"))
            # video_id breaks ties so a range partition never holds all rows of one
            # ratio (every zero-view video has a null ratio)
            .orderBy(F.desc_nulls_last("like_to_view_ratio"), F.asc_nulls_last("video_id")))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` largest distinct values of a column, null ranked last.

    At most ``n`` rows whatever the input size: partial distinct per task,
    then a top-n merge of at most ``n`` rows per partition.
    """
    return (df.select(column).distinct()
            .orderBy(F.col(column).desc_nulls_last()).limit(n))


def top_ranked(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose dense rank by ``column`` (desc, nulls last) is at most ``n``.

    Equal to ``dense_rank() over (order by column desc) <= n`` but without a
    single-partition window: the ``n`` top values (a bounded set, so
    broadcast is safe) are semi-joined back null-safely, and all tied rows
    stay where they are, however many there are.
    """
    top = F.broadcast(top_values(df, column, n).withColumnRenamed(column, "_top"))
    return df.join(top, df[column].eqNullSafe(top["_top"]), "left_semi")


def top_viewed(video_dim: DataFrame, video_fact: DataFrame, n: int = 10) -> DataFrame:
    """Videos of the newest snapshot within the ``n`` highest distinct view
    counts (ties kept, so there can be more than ``n`` rows), most viewed first."""
    top = top_ranked(latest(video_fact).select("video_id", "views_count"), "views_count", n)
    d = video_dim.select("title", "video_id", "channel_id")
    return (d.join(top, "video_id")
            .select("title", "video_id", "channel_id", "views_count")
            .orderBy(F.desc_nulls_last("views_count"), F.asc_nulls_last("video_id")))


def recent_uploads(video_dim: DataFrame, as_of: dt.date, months: int = 12) -> DataFrame:
    """Videos published in ``[as_of - months, as_of]``, both ends included.
    ``months=12*365`` reproduces the original script's 365-year window."""
    d = F.col("published_date")
    start = F.add_months(F.lit(as_of), -months)
    return video_dim.filter(d.between(start, F.lit(as_of)))


def uploads_per_channel(recent: DataFrame) -> DataFrame:
    return (recent.groupBy("channel_id").agg(F.count(F.lit(1)).alias("video_cnt_in_year"))
            .orderBy(F.desc_nulls_last("video_cnt_in_year"), F.asc_nulls_last("channel_id")))


def uploads_per_quarter(recent: DataFrame) -> DataFrame:
    """Uploads per channel and calendar quarter (years merged, as in the
    original report)."""
    q = F.quarter("published_date")
    return (recent.groupBy("channel_id", q.alias("_q"))
            .agg(F.count(F.lit(1)).alias("video_cnt_per_quarter"))
            .select("channel_id", quarter_label("_q").alias("quarter"), "video_cnt_per_quarter", "_q")
            .orderBy(F.asc_nulls_last("channel_id"), F.asc_nulls_last("_q"))
            .drop("_q"))


def uploads_per_month(recent: DataFrame) -> DataFrame:
    """Uploads per channel and calendar month, shown by English month name."""
    m = F.month("published_date")
    return (recent.groupBy("channel_id", m.alias("_m"))
            .agg(F.count(F.lit(1)).alias("video_cnt_per_month"))
            .select("channel_id", month_name_of("_m").alias("month_name"), "video_cnt_per_month", "_m")
            .orderBy(F.asc_nulls_last("channel_id"), F.asc_nulls_last("_m"))
            .drop("_m"))
