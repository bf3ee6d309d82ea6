"""Flattening listing-service records (JSON) into raw listing rows.

The records are read as a JSON text column (or JSON-lines files) and parsed
with a declared schema by ``from_json``; nested fields become columns and
missing keys take the extractor's defaults. A key the extractor requires
but the record lacks gives null here (and fails a quality rule later)
instead of failing the whole run. Text that is not a JSON object of the schema
(a line or page cut short) gives no row; ``split_readable`` hands it back so
that it can be counted and kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions import topic_names
from snapmart.schemas import CHANNEL_API, CHANNEL_PAGE, VIDEO_API, VIDEO_PAGE

# Defaults of the extractor for missing keys.
DEFAULT_LANGUAGE = "en"
DEFAULT_COUNTRY = "global"
DEFAULT_AUDIO_LANGUAGE = "en"
DEFAULT_COUNT = 0


def _count(c: Column, default: bool = False) -> Column:
    v = c.try_cast("bigint")
    return F.coalesce(v, F.lit(DEFAULT_COUNT).cast("bigint")) if default else v


CORRUPT = "_corrupt_record"


def _parsed(json_col: str, schema: T.StructType) -> Column:
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(F.col(json_col), whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _parse(df: DataFrame, json_col: str, schema) -> DataFrame:
    """Readable records as ``r``. The optimizer moves no filter below an explode,
    so the text is parsed once and the filter looks at what that gave."""
    return (df.select(F.explode(F.array(_parsed(json_col, schema))).alias("r"))
            .filter(F.col("r").isNotNull() & F.col(f"r.{CORRUPT}").isNull()))


def split_readable(df: DataFrame, json_col: str, schema) -> tuple[DataFrame, DataFrame]:
    """(rows whose JSON text can be read, the rest: broken, cut short, null)."""
    parsed = _parsed(json_col, schema)
    ok = parsed.isNotNull() & parsed[CORRUPT].isNull()
    return df.filter(ok), df.filter(~ok)


def channel_rows(rec: Column) -> list[Column]:
    s, st = rec["snippet"], rec["statistics"]
    return [
        rec["id"].alias("channel_id"), s["title"].alias("title"),
        s["description"].alias("description"), s["publishedAt"].alias("published_at"),
        F.coalesce(s["defaultLanguage"], F.lit(DEFAULT_LANGUAGE)).alias("default_language"),
        F.coalesce(s["country"], F.lit(DEFAULT_COUNTRY)).alias("country"),
        _count(st["viewCount"]).alias("views_count"),
        _count(st["subscriberCount"]).alias("subscribers_count"),
        _count(st["videoCount"]).alias("videos_count"),
    ]


def video_rows(rec: Column) -> list[Column]:
    s, cd, st = rec["snippet"], rec["contentDetails"], rec["statistics"]
    tags = F.coalesce(s["tags"], F.array().cast("array<string>"))
    return [
        rec["id"].alias("video_id"), s["channelId"].alias("channel_id"),
        s["publishedAt"].alias("published_at"), s["title"].alias("title"),
        s["description"].alias("description"),
        F.array_join(tags, ",").alias("hashtags"),
        F.coalesce(s["localized"]["defaultAudioLanguage"],
                   F.lit(DEFAULT_AUDIO_LANGUAGE)).alias("audio_language"),
        cd["duration"].alias("content_duration"), cd["dimension"].alias("virtual_dimension"),
        cd["definition"].alias("quality_definition"),
        rec["status"]["privacyStatus"].alias("privacy_status"),
        topic_names(rec["topicDetails"]["topicCategories"]).alias("topic_category"),
        _count(st["viewCount"]).alias("views_count"),
        _count(st["likeCount"]).alias("likes_count"),
        _count(st["dislikeCount"], default=True).alias("dislikes_count"),
        _count(st["favoriteCount"]).alias("favorites_count"),
        _count(st["commentCount"], default=True).alias("comments_count"),
    ]


def flatten_channels(df: DataFrame, json_col: str = "value") -> DataFrame:
    """One channel record per row (JSON text) to the 9 raw channel columns
    (published_at kept as the text given)."""
    return _parse(df, json_col, CHANNEL_API).select(*channel_rows(F.col("r")))


def flatten_videos(df: DataFrame, json_col: str = "value") -> DataFrame:
    """One video record per row (JSON text) to the 17 raw video columns."""
    return _parse(df, json_col, VIDEO_API).select(*video_rows(F.col("r")))


def page_items(df: DataFrame, json_col: str, page_schema) -> DataFrame:
    """Every item of every response page, as one row each (a page with no
    items gives none). Pages are independent rows, so the explode runs
    where each page was read; no grouping."""
    return (_parse(df, json_col, page_schema)
            .select(F.explode(F.col("r")["items"]).alias("item")))


def first_items(df: DataFrame, json_col: str, page_schema) -> DataFrame:
    """The first item of each page; pages without items are skipped (the
    extractor gave an empty row for them)."""
    return (_parse(df, json_col, page_schema)
            .select(F.try_element_at(F.col("r")["items"], F.lit(1)).alias("item"))
            .filter(F.col("item").isNotNull()))


def channel_pages(df: DataFrame, json_col: str = "value", first_only: bool = True) -> DataFrame:
    items = (first_items if first_only else page_items)(df, json_col, CHANNEL_PAGE)
    return items.select(*channel_rows(F.col("item")))


def video_pages(df: DataFrame, json_col: str = "value") -> DataFrame:
    return page_items(df, json_col, VIDEO_PAGE).select(*video_rows(F.col("item")))


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    """Each id once (partial distinct per task, then one shuffle of ids)."""
    return df.select(column).distinct()
