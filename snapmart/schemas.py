"""Declared schemas of every table the pipeline reads or writes.

Counts are 64-bit (the API reports view counts above 2**31); every field is
nullable, as in the raw listings.
"""

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Column names and order of the raw listings (fixed values, as written by the
# extractor's CSV header).
RAW_CHANNEL = _struct(
    ("channel_id", S), ("title", S), ("description", S),
    ("published_at", T.TimestampType()), ("default_language", S), ("country", S),
    ("views_count", L), ("subscribers_count", L), ("videos_count", L),
)

RAW_VIDEO = _struct(
    ("video_id", S), ("channel_id", S), ("published_at", S), ("title", S),
    ("description", S), ("hashtags", S), ("audio_language", S),
    ("content_duration", S), ("virtual_dimension", S), ("quality_definition", S),
    ("privacy_status", S), ("topic_category", S),
    ("views_count", L), ("likes_count", L), ("dislikes_count", L),
    ("favorites_count", L), ("comments_count", L),
)

CURATED_CHANNEL = _struct(
    ("channel_id", S), ("title", S), ("description", S), ("published_date", D),
    ("default_language", S), ("country", S),
    ("views_count", L), ("subscribers_count", L), ("videos_count", L),
    ("updated_date", D),
)

CURATED_VIDEO = _struct(
    ("video_id", S), ("channel_id", S), ("published_date", D), ("title", S),
    ("description", S), ("hashtags", T.ArrayType(S)), ("audio_language", S),
    ("content_duration_hour", I), ("content_duration_minutes", I),
    ("content_duration_seconds", I), ("virtual_dimension", S),
    ("quality_definition", S), ("privacy_status", S), ("topic_category", S),
    ("views_count", L), ("likes_count", L), ("dislikes_count", L),
    ("favorites_count", L), ("comments_count", L), ("updated_date", D),
)

# Dimension shapes and the merge column sets (fixed values).
VIDEO_DIM_COLUMNS = [
    "video_id", "channel_id", "published_date", "virtual_dimension",
    "quality_definition", "title", "description", "audio_language",
    "content_duration_hour", "content_duration_minutes", "content_duration_seconds",
    "hashtags", "privacy_status", "topic_category", "updated_date",
]
VIDEO_DIM_UPDATE = [
    "title", "description", "hashtags", "audio_language",
    "content_duration_hour", "content_duration_minutes", "content_duration_seconds",
    "privacy_status", "topic_category", "updated_date",
]
CHANNEL_DIM_COLUMNS = [
    "channel_id", "title", "description", "published_date",
    "default_language", "country", "updated_date",
]
CHANNEL_DIM_UPDATE = ["title", "description", "default_language", "country", "updated_date"]

VIDEO_FACT_COLUMNS = [
    "video_id", "channel_id", "views_count", "likes_count", "dislikes_count",
    "favorites_count", "comments_count", "snapshot_date",
]
CHANNEL_FACT_COLUMNS = [
    "channel_id", "views_count", "subscribers_count", "videos_count", "snapshot_date",
]


def comparable_columns(schema: T.StructType) -> list[str]:
    """Columns that can be hashed and ordered (all but maps and variants)."""
    return [f.name for f in schema.fields
            if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def select_schema(schema: T.StructType, names) -> T.StructType:
    by_name = {f.name: f for f in schema.fields}
    return T.StructType([by_name[n] for n in names])


VIDEO_DIM = select_schema(CURATED_VIDEO, VIDEO_DIM_COLUMNS)
CHANNEL_DIM = select_schema(CURATED_CHANNEL, CHANNEL_DIM_COLUMNS)
VIDEO_FACT = T.StructType(
    select_schema(CURATED_VIDEO, VIDEO_FACT_COLUMNS[:-1]).fields
    + [T.StructField("snapshot_date", S, True)])
CHANNEL_FACT = T.StructType(
    select_schema(CURATED_CHANNEL, CHANNEL_FACT_COLUMNS[:-1]).fields
    + [T.StructField("snapshot_date", S, True)])

DATE_DIM = _struct(
    ("date", D), ("day", I), ("month", I), ("year", I), ("day_of_week", I),
    ("week_of_year", I), ("quarter", I), ("is_weekend", I), ("day_name", S),
    ("month_name", S), ("day_of_year", I), ("datekey", S),
)

RULE_OUTCOME = _struct(
    ("rule", S), ("rule_type", S), ("column", S), ("expected", T.DoubleType()),
    ("actual", T.DoubleType()), ("outcome", S), ("failure_reason", S),
    ("updated_at", D), ("datekey", S),
)

# API payloads (nested records of the listing service), read as JSON text.
CHANNEL_API = T.StructType([
    T.StructField("id", S),
    T.StructField("snippet", _struct(
        ("title", S), ("description", S), ("publishedAt", S),
        ("defaultLanguage", S), ("country", S))),
    T.StructField("statistics", _struct(
        ("viewCount", S), ("subscriberCount", S), ("videoCount", S))),
])

VIDEO_API = T.StructType([
    T.StructField("id", S),
    T.StructField("snippet", T.StructType([
        T.StructField("channelId", S), T.StructField("publishedAt", S),
        T.StructField("title", S), T.StructField("description", S),
        T.StructField("tags", T.ArrayType(S)),
        T.StructField("localized", _struct(("defaultAudioLanguage", S))),
    ])),
    T.StructField("contentDetails", _struct(("duration", S), ("dimension", S), ("definition", S))),
    T.StructField("status", _struct(("privacyStatus", S))),
    T.StructField("topicDetails", T.StructType([T.StructField("topicCategories", T.ArrayType(S))])),
    T.StructField("statistics", _struct(
        ("viewCount", S), ("likeCount", S), ("dislikeCount", S),
        ("favoriteCount", S), ("commentCount", S))),
])

# A listing response: one page of items.
CHANNEL_PAGE = T.StructType([T.StructField("items", T.ArrayType(CHANNEL_API))])
VIDEO_PAGE = T.StructType([T.StructField("items", T.ArrayType(VIDEO_API))])
