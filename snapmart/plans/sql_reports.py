"""The report scripts as Spark SQL over named tables.

For users who run the reports as SQL text: name the stored tables in the
session catalog (``name_tables``) and run with that ``database``, or register
frames as views (``register_tables``) and run without one. Catalyst plans these exactly like the DataFrame reports;
the differences from the original scripts are deliberate: the trend
window is ``:months`` months back from ``:as_of`` (the original subtracted
365 years), month names are spelled from the calendar, sorts name their
null order and break ties by id (so tied rows spread over range
partitions), and top-k is a bounded semi join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from snapmart import schemas
from snapmart.plans.daily import Layout
from snapmart.sources import named

# The rows of a fact's newest day. Over views the day is a scalar subquery that
# reads the day column alone; over named tables the catalog knows it. Either
# prunes the partitions of a stored fact.
_NEWEST = """WITH newest AS (
  SELECT * FROM {db}FACT WHERE snapshot_date = {day})"""
_MAX_DAY = "(SELECT max(f.snapshot_date) FROM {fact} AS f)"

# Tied rows never meet in one window task: the n largest distinct counts (at
# most n rows, the only broadcast) select the rows.
TOP_VIEWED = _NEWEST.replace("FACT", "video_data_fact") + """,
heights AS (
  SELECT views_count AS height FROM newest GROUP BY views_count ORDER BY height DESC NULLS LAST LIMIT {n})
SELECT /*+ BROADCAST(heights) */ d.title, d.video_id, d.channel_id, newest.views_count
FROM newest
LEFT SEMI JOIN heights ON newest.views_count <=> heights.height
JOIN {db}video_data_dim AS d USING (video_id)
ORDER BY views_count DESC NULLS LAST, video_id NULLS LAST"""

LIKES_TO_VIEW_RATIO = _NEWEST.replace("FACT", "video_data_fact") + """
SELECT d.video_id, d.title, d.channel_id, d.published_date,
       newest.views_count, newest.likes_count, newest.dislikes_count,
       try_divide(CAST(newest.likes_count AS DOUBLE), newest.views_count) AS like_to_view_ratio,
       try_divide(CAST(newest.comments_count AS DOUBLE), newest.views_count) AS comment_to_view_ratio
FROM newest JOIN {db}video_data_dim AS d ON d.video_id = newest.video_id
ORDER BY like_to_view_ratio DESC NULLS LAST, video_id NULLS LAST"""

CHANNEL_METRIC = _NEWEST.replace("FACT", "channel_data_fact") + """
SELECT d.channel_id, d.title, newest.{metric}
FROM newest JOIN {db}channel_data_dim AS d ON d.channel_id = newest.channel_id"""

# Uploads of the window, counted by channel and a part of the date.
_UPLOADS = """
FROM {db}video_data_dim
|> WHERE published_date >= add_months(DATE '{as_of}', -{months}) AND published_date <= DATE '{as_of}'
"""

UPLOADS_PER_CHANNEL = _UPLOADS + """|> AGGREGATE count(*) AS video_cnt_in_year GROUP BY channel_id
|> ORDER BY video_cnt_in_year DESC NULLS LAST, channel_id NULLS LAST
"""

UPLOADS_PER_QUARTER = _UPLOADS + """|> EXTEND 'Q' || quarter(published_date) AS quarter
|> AGGREGATE count(*) AS video_cnt_per_quarter GROUP BY channel_id, quarter
|> ORDER BY channel_id NULLS LAST, quarter NULLS LAST
"""

# Months in the order of the calendar.
UPLOADS_PER_MONTH = _UPLOADS + """|> EXTEND month(published_date) AS m
|> AGGREGATE count(*) AS video_cnt_per_month GROUP BY channel_id, m
|> ORDER BY channel_id NULLS LAST, m NULLS LAST
|> SELECT channel_id, date_format(make_date(2000, m, 1), 'MMMM') AS month_name, video_cnt_per_month
"""


def register_tables(video_dim: DataFrame | None = None, video_fact: DataFrame | None = None,
                    channel_dim: DataFrame | None = None,
                    channel_fact: DataFrame | None = None) -> None:
    """Name the tables the SQL refers to (session-scoped temp views)."""
    for name, df in (("video_data_dim", video_dim), ("video_data_fact", video_fact),
                     ("channel_data_dim", channel_dim), ("channel_data_fact", channel_fact)):
        if df is not None:
            df.createOrReplaceTempView(name)


def name_tables(spark: SparkSession, out: Layout, database: str) -> None:
    """Name the stored dimensions (newest version) and facts (days with rows)
    of a layout; call again after a day is published."""
    named.create_database(spark, database, out.root)
    named.name_dimension(spark, f"{database}.video_data_dim", out.video_dim, schemas.VIDEO_DIM)
    named.name_dimension(spark, f"{database}.channel_data_dim", out.channel_dim, schemas.CHANNEL_DIM)
    named.name_days(spark, f"{database}.video_data_fact", out.video_fact, schemas.VIDEO_FACT, "snapshot_date")
    named.name_days(spark, f"{database}.channel_data_fact", out.channel_fact, schemas.CHANNEL_FACT, "snapshot_date")


REPORTS = {
    "top_viewed": TOP_VIEWED,
    "likes_to_view_ratio": LIKES_TO_VIEW_RATIO,
    "channel_video_counts": CHANNEL_METRIC.replace("{metric}", "videos_count"),
    "channel_subscriber_counts": CHANNEL_METRIC.replace("{metric}", "subscribers_count"),
    "uploads_per_channel": UPLOADS_PER_CHANNEL,
    "uploads_per_quarter": UPLOADS_PER_QUARTER,
    "uploads_per_month": UPLOADS_PER_MONTH,
}


def run(spark: SparkSession, name: str, as_of: dt.date | None = None, months: int = 12,
        n: int = 10, database: str | None = None) -> DataFrame:
    """One report; over the named tables of ``database`` when given, else over views."""
    text, values = REPORTS[name], {"n": int(n), "months": int(months), "db": f"{database}." if database else ""}
    if name.startswith("uploads_"):
        if as_of is None:
            raise ValueError(f"{name} needs as_of")
        values["as_of"] = as_of.isoformat()
    else:
        fact = "channel_data_fact" if name.startswith("channel_") else "video_data_fact"
        day = named.newest_day(spark, f"{database}.{fact}") if database else None
        values["day"] = f"'{day}'" if day else "CAST(null AS STRING)" if database else _MAX_DAY.format(fact=fact)
    return spark.sql(text.format(**values))
