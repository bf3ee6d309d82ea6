"""Adapters from the driver's TPC-H-style tables to the pipeline's shapes.

Each adapter is a projection/aggregation over a given table, so the work of
every query built on it grows with the table:

* video    <- orders   (video_id = o_orderkey, channel_id = o_custkey,
                        published on o_orderdate)
* video fact <- lineitem grouped by (l_orderkey, ship year); the snapshot
                key is the year's last day, ``yyyy1231``
* channel  <- customer left join nation (channel_id = c_custkey)
* channel fact <- orders grouped by (o_custkey, order year)

The same shapes are written in DuckDB SQL in ``snapmart.plans.catalog``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _s(c) -> Column:
    return F.col(c).cast("string")


def _year_key(ts: str) -> Column:
    return F.concat(F.year(ts).cast("string"), F.lit("1231"))


def _duration_text(price: str) -> Column:
    p = F.floor(F.col(price)).cast("bigint")
    h, m, s = F.floor(p / 100000), F.floor(p / 1000) % 60, p % 60
    return F.concat(F.lit("PT"), h.cast("string"), F.lit("H"), m.cast("string"),
                    F.lit("M"), s.cast("string"), F.lit("S"))


def raw_video(orders: DataFrame, *more: Column) -> DataFrame:
    """Raw video listing rows (the CSV shape, strings and counts)."""
    return orders.select(
        _s("o_orderkey").alias("video_id"),
        _s("o_custkey").alias("channel_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
        F.concat(F.lit("order-"), _s("o_orderkey")).alias("title"),
        F.concat(F.lit("status "), F.col("o_orderstatus"), F.lit(", priority "),
                 F.col("o_orderpriority")).alias("description"),
        F.concat_ws(",", F.col("o_orderpriority"), F.col("o_orderstatus")).alias("hashtags"),
        F.lit("en").alias("audio_language"),
        _duration_text("o_totalprice").alias("content_duration"),
        F.lit("2d").alias("virtual_dimension"),
        F.col("o_orderpriority").alias("quality_definition"),
        F.col("o_orderstatus").alias("privacy_status"),
        F.lit("Lifestyle").alias("topic_category"),
        F.floor("o_totalprice").cast("bigint").alias("views_count"),
        F.lit(0).cast("bigint").alias("likes_count"),
        F.lit(0).cast("bigint").alias("dislikes_count"),
        F.lit(0).cast("bigint").alias("favorites_count"),
        F.lit(0).cast("bigint").alias("comments_count"),
        *more,
    )


def raw_channel(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Raw channel listing rows; a customer without a nation keeps a null country."""
    n = nation.select("n_nationkey", "n_name")
    return customer.join(n, customer.c_nationkey == n.n_nationkey, "left").select(
        _s("c_custkey").alias("channel_id"),
        F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("description"),
        F.make_timestamp_ntz(F.col("c_nationkey") + 1990, F.lit(1), F.lit(1),
                             F.lit(0), F.lit(0), F.lit(0)).alias("published_at"),
        F.lit("en").alias("default_language"),
        F.col("n_name").alias("country"),
        F.floor(F.col("c_acctbal")).cast("bigint").alias("views_count"),
        F.col("c_nationkey").cast("bigint").alias("subscribers_count"),
        F.lit(0).cast("bigint").alias("videos_count"),
    )


def video_dim(orders: DataFrame, as_of) -> DataFrame:
    """The video dimension (15 columns) as the curation step would give it."""
    from snapmart.functions import iso_duration, split_list
    # the stored date itself, so that a filter on it reaches the scan
    r = raw_video(orders, F.col("o_orderdate").cast("date").alias("published_date"))
    return r.select(
        "video_id", "channel_id", F.col("published_date"),
        "virtual_dimension", "quality_definition", "title", "description", "audio_language",
        *iso_duration("content_duration"),
        split_list("hashtags").alias("hashtags"), "privacy_status", "topic_category",
        F.lit(as_of).cast("date").alias("updated_date"),
    )


def video_fact(lineitem: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Video snapshots: one row per (order, ship year). ``channel_id`` needs
    the orders table; reports that do not read it pass none and skip the join.
    Grouping and joining use the 64-bit order key; ids become text last."""
    agg = lineitem.groupBy(
        "l_orderkey", _year_key("l_shipdate").alias("snapshot_date"),
    ).agg(
        F.sum(F.when(F.col("l_discount") != 0, F.col("l_quantity")).otherwise(F.lit(0.0)))
         .cast("bigint").alias("views_count"),
        F.sum("l_linenumber").cast("bigint").alias("likes_count"),
        F.count_if(F.col("l_returnflag") == "R").alias("dislikes_count"),
        F.count_if(F.col("l_returnflag") == "A").alias("favorites_count"),
        F.count(F.lit(1)).alias("comments_count"),
    )
    if orders is None:
        channel = F.lit(None).cast("string")
    else:
        o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        agg = agg.join(o, "l_orderkey", "left")
        channel = _s("o_custkey")
    return agg.select(_s("l_orderkey").alias("video_id"), channel.alias("channel_id"),
                      "views_count", "likes_count", "dislikes_count", "favorites_count",
                      "comments_count", "snapshot_date")


def channel_dim(customer: DataFrame, nation: DataFrame, as_of) -> DataFrame:
    r = raw_channel(customer, nation)
    return r.select(
        "channel_id", "title", "description", F.to_date("published_at").alias("published_date"),
        "default_language", "country", F.lit(as_of).cast("date").alias("updated_date"))


def channel_fact(orders: DataFrame) -> DataFrame:
    return orders.groupBy(
        "o_custkey", _year_key("o_orderdate").alias("snapshot_date"),
    ).agg(
        F.sum(F.floor("o_totalprice").cast("bigint")).alias("views_count"),
        F.count_if(F.col("o_orderstatus") == "F").alias("subscribers_count"),
        F.count(F.lit(1)).alias("videos_count"),
    ).select(_s("o_custkey").alias("channel_id"), "views_count", "subscribers_count",
             "videos_count", "snapshot_date")
