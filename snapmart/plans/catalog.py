"""Registered queries over the driver's test tables, with DuckDB oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over whole tables; its
oracle is independent SQL over the same parquet files. Column names agree
one for one. Arrays are compared as joined strings.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import schemas
from snapmart.functions import iso_duration, split_list, url_tail
from snapmart.operators import clean, dims, drift, facts, flatten, page_chains, quality, reports, rule_text
from snapmart.plans import sql_reports
from snapmart.plans.daily import Layout
from snapmart.session import scratch_path
from snapmart.sources import (
    read_csv, read_day, read_json_lines, read_latest_version, read_table, write_csv, write_day, write_days, write_json_lines,
)
from snapmart.sources import named
from snapmart.sources import testdata as td
from snapmart.sources.intake import take_day
from snapmart.sources.tables import write_clustered

# The run date of the test data: the last order date.
AS_OF = dt.date(2001, 8, 1)
AS_OF_SQL = "DATE '2001-08-01'"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---- adapters in SQL (same shapes as snapmart.sources.testdata) ----------

VIDEO_DIM_SQL = """video_dim AS (
  SELECT cast(o_orderkey AS VARCHAR) AS video_id,
         cast(o_custkey AS VARCHAR) AS channel_id,
         cast(o_orderdate AS DATE) AS published_date,
         '2d' AS virtual_dimension,
         o_orderpriority AS quality_definition,
         'order-' || cast(o_orderkey AS VARCHAR) AS title,
         'status ' || o_orderstatus || ', priority ' || o_orderpriority AS description,
         'en' AS audio_language,
         cast(cast(floor(o_totalprice) AS BIGINT) // 100000 AS INTEGER) AS content_duration_hour,
         cast((cast(floor(o_totalprice) AS BIGINT) // 1000) % 60 AS INTEGER) AS content_duration_minutes,
         cast(cast(floor(o_totalprice) AS BIGINT) % 60 AS INTEGER) AS content_duration_seconds,
         concat_ws(',', o_orderpriority, o_orderstatus) AS hashtags,
         o_orderstatus AS privacy_status,
         'Lifestyle' AS topic_category,
         @AS_OF AS updated_date
  FROM orders)""".replace("@AS_OF", AS_OF_SQL)

VIDEO_FACT_SQL = """video_fact AS (
  SELECT cast(l_orderkey AS VARCHAR) AS video_id,
         cast(year(l_shipdate) AS VARCHAR) || '1231' AS snapshot_date,
         cast(sum(CASE WHEN l_discount <> 0 THEN l_quantity ELSE 0.0 END) AS BIGINT) AS views_count,
         cast(sum(l_linenumber) AS BIGINT) AS likes_count,
         count(*) FILTER (WHERE l_returnflag = 'R') AS dislikes_count,
         count(*) FILTER (WHERE l_returnflag = 'A') AS favorites_count,
         count(*) AS comments_count
  FROM lineitem GROUP BY 1, 2)"""

CHANNEL_DIM_SQL = """channel_dim AS (
  SELECT cast(c_custkey AS VARCHAR) AS channel_id, c_name AS title,
         c_mktsegment AS description,
         make_date(c_nationkey + 1990, 1, 1) AS published_date,
         'en' AS default_language, n_name AS country,
         @AS_OF AS updated_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)""".replace("@AS_OF", AS_OF_SQL)

CHANNEL_FACT_SQL = """channel_fact AS (
  SELECT cast(o_custkey AS VARCHAR) AS channel_id,
         cast(year(o_orderdate) AS VARCHAR) || '1231' AS snapshot_date,
         cast(sum(cast(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS views_count,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS subscribers_count,
         count(*) AS videos_count
  FROM orders GROUP BY 1, 2)"""


def _video(spark, sf):
    return td.video_dim(td.load(spark, sf, "orders"), AS_OF), td.video_fact(td.load(spark, sf, "lineitem"))


def _channel(spark, sf):
    return (td.channel_dim(td.load(spark, sf, "customer"), td.load(spark, sf, "nation"), AS_OF),
            td.channel_fact(td.load(spark, sf, "orders")))


# ---- reports ---------------------------------------------------------------

# Counts of the newest snapshot; every oracle below starts from these rows.
_NEWEST_SQL = """newest AS (
  SELECT * FROM {fact} WHERE snapshot_date IN (SELECT snapshot_date FROM {fact} ORDER BY snapshot_date DESC LIMIT 1))"""


# A row is among the first n when fewer than n distinct larger counts exist.
@register("top_viewed", f"""
WITH {VIDEO_DIM_SQL}, {VIDEO_FACT_SQL}, {_NEWEST_SQL.format(fact="video_fact")},
bar AS (SELECT min(views_count) AS least FROM (SELECT DISTINCT views_count FROM newest ORDER BY ALL DESC LIMIT 10))
SELECT title, video_id, channel_id, newest.views_count
FROM newest JOIN video_dim USING (video_id) CROSS JOIN bar
WHERE newest.views_count >= least
ORDER BY views_count DESC NULLS LAST, video_id""")
def q_top_viewed(spark, sf):
    dim, fact = _video(spark, sf)
    return reports.top_viewed(dim, fact, 10)


@register("engagement_ratio", f"""
WITH {VIDEO_DIM_SQL}, {VIDEO_FACT_SQL}, {_NEWEST_SQL.format(fact="video_fact")}
SELECT video_id, title, channel_id, published_date, newest.views_count, newest.likes_count, newest.dislikes_count,
       CASE WHEN newest.views_count <> 0 THEN newest.likes_count::DOUBLE / newest.views_count END AS like_to_view_ratio,
       CASE WHEN newest.views_count <> 0 THEN newest.comments_count::DOUBLE / newest.views_count END AS comment_to_view_ratio
FROM video_dim JOIN newest USING (video_id)
ORDER BY like_to_view_ratio DESC NULLS LAST, video_id""")
def q_engagement_ratio(spark, sf):
    dim, fact = _video(spark, sf)
    return reports.engagement_ratio(dim, fact)


_CHANNEL_METRIC_SQL = """
WITH {dim}, {fact}, newest AS (
  SELECT channel_id, {metric} FROM channel_fact
  QUALIFY snapshot_date = max(snapshot_date) OVER ())
SELECT channel_id, title, {metric} FROM newest JOIN channel_dim USING (channel_id)"""


@register("channel_video_counts", _CHANNEL_METRIC_SQL.format(
    dim=CHANNEL_DIM_SQL, fact=CHANNEL_FACT_SQL, metric="videos_count"))
def q_channel_video_counts(spark, sf):
    return reports.channel_video_counts(*_channel(spark, sf))


@register("channel_subscriber_counts", _CHANNEL_METRIC_SQL.format(
    dim=CHANNEL_DIM_SQL, fact=CHANNEL_FACT_SQL, metric="subscribers_count"))
def q_channel_subscriber_counts(spark, sf):
    return reports.channel_subscriber_counts(*_channel(spark, sf))


_RECENT_SQL = f"""recent AS (SELECT * FROM video_dim
  WHERE published_date BETWEEN cast({AS_OF_SQL} - INTERVAL 12 MONTH AS DATE) AND {AS_OF_SQL})"""


def _recent(spark, sf):
    return reports.recent_uploads(td.video_dim(td.load(spark, sf, "orders"), AS_OF), AS_OF, 12)


@register("trend_channel", f"""
WITH {VIDEO_DIM_SQL}, {_RECENT_SQL}
SELECT channel_id, count(*) AS video_cnt_in_year FROM recent GROUP BY channel_id
ORDER BY video_cnt_in_year DESC, channel_id""")
def q_trend_channel(spark, sf):
    return reports.uploads_per_channel(_recent(spark, sf))


@register("trend_quarter", f"""
WITH {VIDEO_DIM_SQL}, {_RECENT_SQL}
SELECT channel_id, 'Q' || cast(quarter(published_date) AS VARCHAR) AS quarter,
       count(*) AS video_cnt_per_quarter
FROM recent GROUP BY quarter(published_date), channel_id
ORDER BY channel_id, quarter""")
def q_trend_quarter(spark, sf):
    return reports.uploads_per_quarter(_recent(spark, sf))


@register("trend_month", f"""
WITH {VIDEO_DIM_SQL}, {_RECENT_SQL}
SELECT channel_id, monthname(make_date(2000, month(published_date), 1)) AS month_name,
       count(*) AS video_cnt_per_month
FROM recent GROUP BY channel_id, month(published_date)
ORDER BY channel_id, month(published_date)""")
def q_trend_month(spark, sf):
    return reports.uploads_per_month(_recent(spark, sf))


# ---- sources, cleaning, flattening ----------------------------------------



# Fixed parameter: the five channels (customers) of the allow-list checks.
FIVE_CHANNELS = ["7", "42", "99", "256", "1000"]
_FIVE_SQL = ", ".join(f"'{c}'" for c in FIVE_CHANNELS)
# Allowed channels for curation: customers outside one market segment.
EXCLUDED_SEGMENT = "HOUSEHOLD"


def _allowed_channels(spark, sf):
    cust = td.load(spark, sf, "customer")
    return (cust.filter(F.col("c_mktsegment") != EXCLUDED_SEGMENT)
            .select(F.col("c_custkey").cast("string").alias("channel_id")))


@register("split_allowed", f"""
SELECT cast(o_orderkey AS VARCHAR) AS video_id, channel_id,
       CASE WHEN channel_id IN (SELECT cast(c_custkey AS VARCHAR) FROM customer
                                WHERE c_mktsegment <> '{EXCLUDED_SEGMENT}') THEN 'clean' ELSE 'corrupt' END AS part
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN cast(o_custkey AS VARCHAR) END AS channel_id FROM orders)""")
def q_split_allowed(spark, sf):
    """Both parts of a split by a table of channels; some rows lack a channel."""
    raw = td.raw_video(td.load(spark, sf, "orders")).select(
        "video_id", F.when(F.col("privacy_status") != "P", F.col("channel_id")).alias("channel_id"))
    ok, bad = clean.split_allowed(raw, "channel_id", _allowed_channels(spark, sf))
    return ok.withColumn("part", F.lit("clean")).unionByName(bad.withColumn("part", F.lit("corrupt")))


@register("csv_roundtrip", "SELECT doc_id, text FROM documents")
def q_csv_roundtrip(spark, sf):
    """Whole documents written as CSV and read back with the declared schema;
    quotes, commas and newlines inside the text survive."""
    path = scratch_path(spark, "csv_roundtrip")
    write_csv(td.load(spark, sf, "documents").select("doc_id", "text"), path)
    schema = schemas._struct(("doc_id", schemas.L), ("text", schemas.S))
    return read_csv(spark, path, schema)


@register("allow_split", f"""
SELECT CASE WHEN cast(o_custkey AS VARCHAR) IN ({_FIVE_SQL}) THEN 'clean' ELSE 'corrupt' END AS part,
       cast(o_orderkey AS VARCHAR) AS video_id, cast(o_custkey AS VARCHAR) AS channel_id
FROM orders""")
def q_allow_split(spark, sf):
    raw = td.raw_video(td.load(spark, sf, "orders")).select("video_id", "channel_id")
    return clean.label_allowed(raw, "channel_id", FIVE_CHANNELS)


def _profile_input(raw):
    # some values null and some holding the text NULL
    return (raw.withColumn("hashtags", F.when(F.col("privacy_status") != "P", F.col("hashtags")))
               .withColumn("description", F.when(F.col("quality_definition") == "5-LOW", F.lit("NULL"))
                           .otherwise(F.col("description"))))


_RAW_VIDEO_SQL = """raw AS (
  SELECT cast(o_orderkey AS VARCHAR) AS video_id, cast(o_custkey AS VARCHAR) AS channel_id,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
         'order-' || cast(o_orderkey AS VARCHAR) AS title,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'NULL'
              ELSE 'status ' || o_orderstatus || ', priority ' || o_orderpriority END AS description,
         CASE WHEN o_orderstatus <> 'P' THEN concat_ws(',', o_orderpriority, o_orderstatus) END AS hashtags,
         'en' AS audio_language, 'PT' AS content_duration, '2d' AS virtual_dimension,
         o_orderpriority AS quality_definition, o_orderstatus AS privacy_status,
         'Lifestyle' AS topic_category, cast(floor(o_totalprice) AS BIGINT) AS views_count,
         0 AS likes_count, 0 AS dislikes_count, 0 AS favorites_count, 0 AS comments_count
  FROM orders)"""


def _profile_sql():
    cols = [f.name for f in schemas.RAW_VIDEO.fields]
    ok = (f"channel_id IN (SELECT cast(c_custkey AS VARCHAR) FROM customer "
          f"WHERE c_mktsegment <> '{EXCLUDED_SEGMENT}')")
    parts = [f"count(*) FILTER (WHERE {ok} AND ({c} IS NULL OR cast({c} AS VARCHAR) LIKE '%NULL%')) AS {c}"
             for c in cols]
    parts.append(f"count(*) FILTER (WHERE NOT coalesce({ok}, false)) AS corrupt_records")
    return f"WITH {_RAW_VIDEO_SQL}\nSELECT " + ",\n  ".join(parts) + "\nFROM raw"


@register("null_profile", _profile_sql())
def q_null_profile(spark, sf):
    """Null / ``NULL`` counts over the clean rows and the corrupt count, one
    pass; the allow-list is a table (channels outside one segment)."""
    raw = _profile_input(td.raw_video(td.load(spark, sf, "orders")))
    return clean.profile(raw, "channel_id", _allowed_channels(spark, sf))


_DURATION_VARIANTS_SQL = """
  ['PT' || cast(p_size AS VARCHAR) || 'M',
   'PT' || cast(p_size // 10 AS VARCHAR) || 'H' || cast(p_size % 10 AS VARCHAR) || 'S',
   'P' || cast(p_size AS VARCHAR) || 'DT' || cast(p_size AS VARCHAR) || 'H',
   'PT' || cast(p_size AS VARCHAR) || 'H' || lpad(cast(p_size AS VARCHAR), 2, '0') || 'M' || cast(p_size AS VARCHAR) || 'S',
   CASE WHEN p_size > 40 THEN '' ELSE 'P0D' END]"""


def _duration_variants():
    s = F.col("p_size").cast("string")
    return F.array(
        F.concat(F.lit("PT"), s, F.lit("M")),
        F.concat(F.lit("PT"), (F.col("p_size") / 10).cast("int").cast("string"), F.lit("H"),
                 (F.col("p_size") % 10).cast("string"), F.lit("S")),
        F.concat(F.lit("P"), s, F.lit("DT"), s, F.lit("H")),
        F.concat(F.lit("PT"), s, F.lit("H"), F.lpad(s, 2, "0"), F.lit("M"), s, F.lit("S")),
        F.when(F.col("p_size") > 40, F.lit("")).otherwise(F.lit("P0D")),
    )


@register("iso_duration", f"""
WITH d AS (SELECT p_partkey, {_DURATION_VARIANTS_SQL} AS l FROM part),
e AS (SELECT p_partkey, unnest(range(5)) AS variant, unnest(l) AS duration FROM d)
SELECT p_partkey, variant, duration,
  coalesce(try_cast(nullif(regexp_extract(duration, 'PT((\\d+)H)?((\\d+)M)?((\\d+)S)?', 2), '') AS INTEGER), 0) AS content_duration_hour,
  coalesce(try_cast(nullif(regexp_extract(duration, 'PT((\\d+)H)?((\\d+)M)?((\\d+)S)?', 4), '') AS INTEGER), 0) AS content_duration_minutes,
  coalesce(try_cast(nullif(regexp_extract(duration, 'PT((\\d+)H)?((\\d+)M)?((\\d+)S)?', 6), '') AS INTEGER), 0) AS content_duration_seconds
FROM e""")
def q_iso_duration(spark, sf):
    e = td.load(spark, sf, "part").select(
        "p_partkey", F.posexplode(_duration_variants()).alias("variant", "duration"))
    return e.select("p_partkey", F.col("variant").cast("bigint").alias("variant"), "duration",
                    *iso_duration("duration"))


@register("distinct_ids", "SELECT DISTINCT cast(l_orderkey AS VARCHAR) AS video_id FROM lineitem")
def q_distinct_ids(spark, sf):
    li = td.load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("video_id"))
    return flatten.distinct_ids(li, "video_id").select(F.col("video_id").cast("string").alias("video_id"))


@register("duplicate_keys", """
SELECT cast(l_orderkey AS VARCHAR) AS video_id, count(*) AS key_count
FROM lineitem GROUP BY 1 HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf):
    li = td.load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("video_id"))
    found = dims.duplicate_keys(li, ["video_id"])
    return found.select(F.col("video_id").cast("string").alias("video_id"), "key_count")


# JSON records built from the events table (a missing key for some rows).
def _channel_json(events):
    k = F.get_json_object("props", "$.k")
    rec = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(F.col("event_type").alias("title"), F.col("props").alias("description"),
                 F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
                 F.when(F.col("event_type") != "view", F.lit("fr")).alias("defaultLanguage"),
                 F.when(F.col("value") > 20, F.lit("SG")).alias("country")).alias("snippet"),
        F.struct(k.alias("viewCount"), F.col("user_id").cast("string").alias("subscriberCount"),
                 F.floor("value").cast("string").alias("videoCount")).alias("statistics"),
    )
    return events.select(F.to_json(rec).alias("value"))


@register("flatten_channels", """
SELECT cast(event_id AS VARCHAR) AS channel_id, event_type AS title, props AS description,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
       CASE WHEN event_type <> 'view' THEN 'fr' ELSE 'en' END AS default_language,
       CASE WHEN value > 20 THEN 'SG' ELSE 'global' END AS country,
       try_cast(json_extract_string(props, '$.k') AS BIGINT) AS views_count,
       user_id AS subscribers_count, cast(floor(value) AS BIGINT) AS videos_count
FROM events""")
def q_flatten_channels(spark, sf):
    return flatten.flatten_channels(_channel_json(td.load(spark, sf, "events")))


def _video_json(part):
    words = F.split("p_name", " ")
    rec = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.struct(F.col("p_brand").alias("channelId"), F.lit("2001-08-01T00:00:00Z").alias("publishedAt"),
                 F.col("p_name").alias("title"), F.col("p_type").alias("description"),
                 F.when(F.col("p_size") > 10, words).alias("tags"),
                 F.struct(F.when(F.col("p_size") <= 25, F.lit("de")).alias("defaultAudioLanguage"))
                  .alias("localized")).alias("snippet"),
        F.struct(F.concat(F.lit("PT"), F.col("p_size").cast("string"), F.lit("M")).alias("duration"),
                 F.lit("2d").alias("dimension"), F.lit("hd").alias("definition")).alias("contentDetails"),
        F.struct(F.lit("public").alias("privacyStatus")).alias("status"),
        F.when(F.col("p_size") > 5, F.struct(F.array(
            F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.col("p_brand")),
            F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.regexp_replace("p_type", " ", "_")))
            .alias("topicCategories"))).alias("topicDetails"),
        F.struct(F.floor("p_retailprice").cast("string").alias("viewCount"),
                 F.col("p_size").cast("string").alias("likeCount"),
                 F.when(F.col("p_size") > 30, F.col("p_size").cast("string")).alias("dislikeCount"),
                 F.lit("0").alias("favoriteCount"),
                 F.when(F.col("p_size") < 45, F.lit("3")).alias("commentCount")).alias("statistics"),
    )
    return part.select(F.to_json(rec).alias("value"))


@register("flatten_videos", """
SELECT cast(p_partkey AS VARCHAR) AS video_id, p_brand AS channel_id,
       '2001-08-01T00:00:00Z' AS published_at, p_name AS title, p_type AS description,
       CASE WHEN p_size > 10 THEN array_to_string(string_split(p_name, ' '), ',') ELSE '' END AS hashtags,
       CASE WHEN p_size <= 25 THEN 'de' ELSE 'en' END AS audio_language,
       'PT' || cast(p_size AS VARCHAR) || 'M' AS content_duration, '2d' AS virtual_dimension,
       'hd' AS quality_definition, 'public' AS privacy_status,
       CASE WHEN p_size > 5 THEN p_brand || ',' || replace(p_type, ' ', '_') ELSE '' END AS topic_category,
       cast(floor(p_retailprice) AS BIGINT) AS views_count, cast(p_size AS BIGINT) AS likes_count,
       CASE WHEN p_size > 30 THEN cast(p_size AS BIGINT) ELSE 0 END AS dislikes_count,
       cast(0 AS BIGINT) AS favorites_count,
       cast(CASE WHEN p_size < 45 THEN 3 ELSE 0 END AS BIGINT) AS comments_count
FROM part""")
def q_flatten_videos(spark, sf):
    return flatten.flatten_videos(_video_json(td.load(spark, sf, "part")))


# Stored responses: a page for each part, some cut short on the way.
def _stored_video_pages(spark, sf):
    one = _video_json(td.load(spark, sf, "part"))
    size = F.try_element_at(F.split(F.get_json_object("value", "$.contentDetails.duration"), "[TM]"), F.lit(2))
    page = F.concat(F.lit('{"items":['), F.col("value"), F.lit("]}"))
    path = scratch_path(spark, "video_pages")
    write_json_lines(one.select(F.when(size % 7 == 0, F.substring(page, 1, 60)).otherwise(page).alias("value")), path)
    return read_json_lines(spark, path)


@register("video_pages", ORACLE["flatten_videos"] + " WHERE p_size % 7 <> 0")
def q_video_pages(spark, sf):
    """Every item of every readable page of a folder of JSON-lines files."""
    return flatten.video_pages(_stored_video_pages(spark, sf))


@register("broken_pages", """
SELECT count(*) FILTER (WHERE p_size % 7 <> 0) AS readable, count(*) FILTER (WHERE p_size % 7 = 0) AS broken FROM part""")
def q_broken_pages(spark, sf):
    """Pages that can be read and pages that were cut short, counted."""
    good, bad = flatten.split_readable(_stored_video_pages(spark, sf), "value", schemas.VIDEO_PAGE)
    told = good.select(F.lit(1).alias("r"), F.lit(0).alias("b")).unionAll(bad.select(F.lit(0), F.lit(1)))
    return told.agg(F.sum("r").alias("readable"), F.sum("b").alias("broken"))


@register("topic_tail", """
SELECT page_id, string_split(url, '/')[-1] AS topic_category FROM pages""")
def q_topic_tail(spark, sf):
    return td.load(spark, sf, "pages").select("page_id", url_tail("url").alias("topic_category"))


@register("tags_split", """
SELECT p_partkey, array_to_string(string_split(array_to_string(string_split(p_name, ' '), ','), ','), '|') AS tags,
       len(string_split(array_to_string(string_split(p_name, ' '), ','), ',')) AS tag_count
FROM part""")
def q_tags_split(spark, sf):
    joined = F.array_join(F.split("p_name", " "), ",")
    tags = split_list(joined)
    return td.load(spark, sf, "part").select(
        "p_partkey", F.array_join(tags, "|").alias("tags"), F.size(tags).cast("bigint").alias("tag_count"))


# Response pages built from conversation turns: one page per turn, one item
# per non-empty line of its text (a turn of blank text gives an empty page).
def _conversation_pages(conv):
    lines = F.filter(F.split("text", "\n"), lambda x: x != "")
    items = F.transform(lines, lambda x, i: F.struct(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"),
                    i.cast("string")).alias("id"),
        F.struct(x.alias("title"), F.col("role").alias("description")).alias("snippet")))
    return conv.select(F.to_json(F.struct(items.alias("items"))).alias("value"))


_CONV_LINES_SQL = """l AS (SELECT conv_id, turn, role,
    list_filter(string_split(text, chr(10)), lambda x: x <> '') AS lines FROM conversations)"""


@register("page_items", f"""
WITH {_CONV_LINES_SQL},
e AS (SELECT conv_id, turn, role, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM l)
SELECT cast(conv_id AS VARCHAR) || '-' || cast(turn AS VARCHAR) || '-' || cast(i AS VARCHAR) AS channel_id,
       line AS title, role AS description
FROM e""")
def q_page_items(spark, sf):
    pages = _conversation_pages(td.load(spark, sf, "conversations"))
    return flatten.channel_pages(pages, first_only=False).select("channel_id", "title", "description")


@register("first_items", f"""
WITH {_CONV_LINES_SQL}
SELECT cast(conv_id AS VARCHAR) || '-' || cast(turn AS VARCHAR) || '-0' AS channel_id,
       lines[1] AS title, role AS description
FROM l WHERE len(lines) > 0""")
def q_first_items(spark, sf):
    pages = _conversation_pages(td.load(spark, sf, "conversations"))
    return flatten.channel_pages(pages, first_only=True).select("channel_id", "title", "description")


# ---- dimensions, facts, quality ------------------------------------------


DAY1 = dt.date(2000, 1, 1)
DAY1_SQL = "DATE '2000-01-01'"


def _joined_tags(df):
    return df.withColumn("hashtags", F.array_join("hashtags", ","))


@register("date_dim", """
WITH span AS (SELECT min(cast(o_orderdate AS DATE)) AS s, max(cast(o_orderdate AS DATE)) AS e FROM orders),
days AS (SELECT cast(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM span)
SELECT date, cast(day(date) AS INTEGER) AS day, cast(month(date) AS INTEGER) AS month,
       cast(year(date) AS INTEGER) AS year, cast(isodow(date) AS INTEGER) AS day_of_week,
       cast(weekofyear(date) AS INTEGER) AS week_of_year, cast(quarter(date) AS INTEGER) AS quarter,
       cast(isodow(date) >= 6 AS INTEGER) AS is_weekend, dayname(date) AS day_name,
       monthname(date) AS month_name, cast(dayofyear(date) AS INTEGER) AS day_of_year,
       strftime(date, '%Y%m%d') AS datekey
FROM days""")
def q_date_dim(spark, sf):
    """Date dimension over the span of order dates, stored by year and month
    and read back."""
    d = dims.date_dim_covering(td.load(spark, sf, "orders"), "o_orderdate")
    path = scratch_path(spark, "date_dim")
    dims.write_date_dim(d, path)
    return read_table(spark, path, schemas.DATE_DIM).select(*schemas.DATE_DIM.fieldNames())


def _null_id_when(priority):
    # a listing whose id went missing: pending videos of one priority
    lost = (F.col("privacy_status") == "P") & (F.col("quality_definition") == priority)
    return F.when(~lost, F.col("video_id"))


def _video_slices(spark, sf):
    """Day 1: videos published before 2000; day 2: from 1999 on, with new
    titles, a changed kept column, null statuses; some ids null on each day."""
    dim = td.video_dim(td.load(spark, sf, "orders"), AS_OF)
    day1 = (dim.filter(F.col("published_date") < F.lit(DAY1))
            .withColumn("updated_date", F.lit(DAY1))
            .withColumn("video_id", _null_id_when("1-URGENT")))
    day2 = (dim.filter(F.col("published_date") >= F.lit(dt.date(1999, 1, 1)))
            .withColumn("video_id", _null_id_when("2-HIGH"))
            .withColumn("channel_id", F.concat(F.lit("moved-"), "channel_id"))
            .withColumn("title", F.concat("title", F.lit("-v2")))
            .withColumn("privacy_status", F.when(F.col("privacy_status") != "P", F.col("privacy_status"))))
    return day1, day2


def _merge_stored_days(spark, name, day1, day2, schema, keys, update, insert):
    """As the consumption job does: each day lands as a curated day partition,
    then each stored day is merged into the dimension in turn."""
    root = scratch_path(spark, name)
    cols = [f.name for f in schema.fields]
    write_days(day1.select(*cols), f"{root}/curated", "updated_date")
    write_days(day2.select(*cols).withColumn("updated_date", F.lit(AS_OF)), f"{root}/curated", "updated_date")
    out = None
    for day in (DAY1, AS_OF):
        src = read_day(spark, f"{root}/curated", schema, day)
        out = dims.load_dimension(spark, f"{root}/dim", src, schema, keys, update, insert, day)
    return out


@register("scd1_merge_video", f"""
WITH {VIDEO_DIM_SQL},
t AS (SELECT * REPLACE ({DAY1_SQL} AS updated_date,
        CASE WHEN privacy_status = 'P' AND quality_definition = '1-URGENT' THEN NULL ELSE video_id END AS video_id),
        true AS _t
      FROM video_dim WHERE published_date < {DAY1_SQL}),
s AS (SELECT * REPLACE ('moved-' || channel_id AS channel_id, title || '-v2' AS title,
        CASE WHEN privacy_status <> 'P' THEN privacy_status END AS privacy_status,
        CASE WHEN privacy_status = 'P' AND quality_definition = '2-HIGH' THEN NULL ELSE video_id END AS video_id),
        true AS _s
      FROM video_dim WHERE published_date >= DATE '1999-01-01')
SELECT CASE WHEN t._t IS NULL THEN s.video_id ELSE t.video_id END AS video_id,
""" + ",\n".join(
    (f"CASE WHEN s._s IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
     if c in schemas.VIDEO_DIM_UPDATE else
     f"CASE WHEN t._t IS NULL THEN s.{c} ELSE t.{c} END AS {c}")
    for c in schemas.VIDEO_DIM_COLUMNS[1:]) + """
FROM t FULL OUTER JOIN s ON t.video_id = s.video_id""")
def q_scd1_merge_video(spark, sf):
    day1, day2 = _video_slices(spark, sf)
    return _joined_tags(_merge_stored_days(
        spark, "video_dim", day1, day2, schemas.VIDEO_DIM, ["video_id"],
        schemas.VIDEO_DIM_UPDATE, schemas.VIDEO_DIM_COLUMNS))


@register("scd1_merge_channel", f"""
WITH {CHANNEL_DIM_SQL},
cn AS (SELECT c.*, c_nationkey AS nk FROM channel_dim c JOIN customer ON channel_id = cast(c_custkey AS VARCHAR)),
t AS (SELECT * EXCLUDE (nk) REPLACE ({DAY1_SQL} AS updated_date) FROM cn WHERE nk < 15),
s AS (SELECT * EXCLUDE (nk) REPLACE (title || '-v2' AS title, DATE '2001-01-01' AS published_date,
        CASE WHEN nk <> 20 THEN country END AS country) FROM cn WHERE nk >= 10)
SELECT CASE WHEN t.channel_id IS NULL THEN s.channel_id ELSE t.channel_id END AS channel_id,
""" + ",\n".join(
    (f"CASE WHEN s.channel_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
     if c in schemas.CHANNEL_DIM_UPDATE else
     f"CASE WHEN t.channel_id IS NULL THEN s.{c} ELSE t.{c} END AS {c}")
    for c in schemas.CHANNEL_DIM_COLUMNS[1:]) + """
FROM t FULL OUTER JOIN s ON t.channel_id = s.channel_id""")
def q_scd1_merge_channel(spark, sf):
    dim = td.channel_dim(td.load(spark, sf, "customer"), td.load(spark, sf, "nation"), AS_OF)
    dim = dim.withColumn("nk", F.year("published_date") - 1990)
    day1 = dim.filter(F.col("nk") < 15).withColumn("updated_date", F.lit(DAY1)).drop("nk")
    day2 = (dim.filter(F.col("nk") >= 10)
            .withColumn("title", F.concat("title", F.lit("-v2")))
            .withColumn("published_date", F.lit(dt.date(2001, 1, 1)))
            .withColumn("country", F.when(F.col("nk") != 20, F.col("country"))).drop("nk"))
    return _merge_stored_days(spark, "channel_dim", day1, day2, schemas.CHANNEL_DIM, ["channel_id"],
                              schemas.CHANNEL_DIM_UPDATE, schemas.CHANNEL_DIM_COLUMNS)


@register("scd1_first_load", f"WITH {CHANNEL_DIM_SQL} SELECT * FROM channel_dim")
def q_scd1_first_load(spark, sf):
    dim = td.channel_dim(td.load(spark, sf, "customer"), td.load(spark, sf, "nation"), AS_OF)
    path = scratch_path(spark, "channel_dim_first")
    return dims.load_dimension(spark, path, dim, schemas.CHANNEL_DIM, ["channel_id"],
                               schemas.CHANNEL_DIM_UPDATE, schemas.CHANNEL_DIM_COLUMNS, AS_OF)


@register("scd1_first_load_video", f"""
WITH {VIDEO_DIM_SQL} SELECT {", ".join(schemas.VIDEO_DIM_COLUMNS)} FROM video_dim""")
def q_scd1_first_load_video(spark, sf):
    """The video dimension's first load, stored and read back."""
    dim = td.video_dim(td.load(spark, sf, "orders"), AS_OF)
    return _joined_tags(dims.load_dimension(
        spark, scratch_path(spark, "video_dim_first"), dim, schemas.VIDEO_DIM, ["video_id"],
        schemas.VIDEO_DIM_UPDATE, schemas.VIDEO_DIM_COLUMNS, AS_OF))


@register("scd1_merge_latest", f"""
WITH {CHANNEL_DIM_SQL}, numbered AS (SELECT *, year(published_date) - 1990 AS nk FROM channel_dim)
SELECT channel_id, CASE WHEN nk >= 10 THEN title || '-v3' ELSE title END AS title, description, published_date,
       default_language, country, CASE WHEN nk >= 10 THEN DATE '2001-08-03' ELSE {DAY1_SQL} END AS updated_date
FROM numbered""")
def q_scd1_merge_latest(spark, sf):
    """A source with three rows for each key; the newest of them is merged."""
    dim = td.channel_dim(td.load(spark, sf, "customer"), td.load(spark, sf, "nation"), AS_OF)
    nk = F.year("published_date") - 1990
    day1 = dim.filter(nk < 15).withColumn("updated_date", F.lit(DAY1))
    turn = F.explode(F.array(F.lit(2), F.lit(3), F.lit(1)))
    source = (dim.filter(nk >= 10).withColumn("turn", turn)
              .withColumn("title", F.concat("title", F.lit("-v"), "turn"))
              .withColumn("updated_date", F.date_add("updated_date", F.col("turn") - 1)).drop("turn"))
    return dims.scd1_merge(day1, source, ["channel_id"], schemas.CHANNEL_DIM_COLUMNS[1:],
                           schemas.CHANNEL_DIM_COLUMNS, on_duplicate="latest")


@register("fact_snapshot", f"""
WITH {VIDEO_FACT_SQL}
SELECT f.video_id, cast(o_custkey AS VARCHAR) AS channel_id, views_count, likes_count,
       dislikes_count, favorites_count, comments_count, snapshot_date
FROM video_fact f LEFT JOIN orders ON f.video_id = cast(o_orderkey AS VARCHAR)""")
def q_fact_snapshot(spark, sf):
    """Every yearly snapshot written at once, the newest written again (a
    rerun), and the table read back: each day holds one copy."""
    fact = td.video_fact(td.load(spark, sf, "lineitem"), td.load(spark, sf, "orders"))
    fact = fact.select(*schemas.VIDEO_FACT_COLUMNS)
    path = scratch_path(spark, "video_fact")
    facts.write_snapshot(fact, path, rebalance=True)  # a backfill of every year
    facts.write_snapshot(reports.latest(fact), path)
    return facts.read_snapshots(spark, path, schemas.VIDEO_FACT).select(*schemas.VIDEO_FACT_COLUMNS)


_CURATED_CHANNEL_SQL = f"""curated AS (
  SELECT cast(c_custkey AS VARCHAR) AS channel_id, c_name AS title, c_mktsegment AS description,
         make_date(c_nationkey + 1990, 1, 1) AS published_date, 'en' AS default_language,
         n_name AS country, cast(floor(c_acctbal) AS BIGINT) AS views_count,
         cast(c_nationkey AS BIGINT) AS subscribers_count, cast(0 AS BIGINT) AS videos_count,
         {AS_OF_SQL} AS updated_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

_CURATED_VIDEO_SQL = f"""curated AS (
  SELECT cast(o_orderkey AS VARCHAR) AS video_id, cast(o_custkey AS VARCHAR) AS channel_id,
         cast(o_orderdate AS DATE) AS published_date
  FROM orders)"""


@register("fact_from_curated_video", f"""
WITH {VIDEO_DIM_SQL}
SELECT video_id, channel_id, cast(floor(o_totalprice) AS BIGINT) AS views_count, cast(0 AS BIGINT) AS likes_count,
       cast(0 AS BIGINT) AS dislikes_count, cast(0 AS BIGINT) AS favorites_count, cast(0 AS BIGINT) AS comments_count,
       strftime({AS_OF_SQL}, '%Y%m%d') AS snapshot_date
FROM video_dim JOIN orders ON video_id = cast(o_orderkey AS VARCHAR)""")
def q_fact_from_curated_video(spark, sf):
    """As the consumption job: the stored curated day becomes the day's facts."""
    root = scratch_path(spark, "video_facts")
    curated = clean.curate_video(td.raw_video(td.load(spark, sf, "orders")), AS_OF)
    write_day(curated, f"{root}/curated", "updated_date", AS_OF)
    day = read_day(spark, f"{root}/curated", schemas.CURATED_VIDEO, AS_OF)
    facts.write_snapshot_day(facts.video_snapshot(day, AS_OF), f"{root}/fact", AS_OF)
    return facts.read_latest_snapshot(spark, f"{root}/fact", schemas.VIDEO_FACT).select(*schemas.VIDEO_FACT_COLUMNS)


@register("fact_from_curated_channel", f"""
WITH {_CURATED_CHANNEL_SQL}
SELECT {", ".join(schemas.CHANNEL_FACT_COLUMNS[:-1])}, strftime({AS_OF_SQL}, '%Y%m%d') AS snapshot_date FROM curated""")
def q_fact_from_curated_channel(spark, sf):
    root = scratch_path(spark, "channel_facts")
    raw = td.raw_channel(td.load(spark, sf, "customer"), td.load(spark, sf, "nation"))
    write_day(clean.curate_channel(raw, AS_OF), f"{root}/curated", "updated_date", AS_OF)
    day = read_day(spark, f"{root}/curated", schemas.CURATED_CHANNEL, AS_OF)
    facts.write_snapshot_day(facts.channel_snapshot(day, AS_OF), f"{root}/fact", AS_OF)
    return facts.read_latest_snapshot(spark, f"{root}/fact", schemas.CHANNEL_FACT).select(*schemas.CHANNEL_FACT_COLUMNS)


@register("rerun_day", f"""
SELECT {DAY1_SQL} AS updated_date, count(*) AS videos FROM orders
UNION ALL SELECT {AS_OF_SQL}, count(*) FROM orders WHERE o_custkey % 2 = 0""")
def q_rerun_day(spark, sf):
    """Two stored days, the second one run again with fewer channels, and a
    third run again with none: each day holds its last run."""
    path = scratch_path(spark, "rerun")
    curated = clean.curate_video(td.raw_video(td.load(spark, sf, "orders")), AS_OF)
    later = AS_OF + dt.timedelta(days=1)
    for day, rows in ((DAY1, curated), (AS_OF, curated), (later, curated),
                      (AS_OF, curated.filter(F.col("channel_id").cast("bigint") % 2 == 0)), (later, curated.limit(0))):
        write_day(rows, path, "updated_date", day)
    stored = read_table(spark, path, schemas.CURATED_VIDEO)
    return stored.groupBy("updated_date").agg(F.count(F.lit(1)).alias("videos"))


def _dq_sql(cte: str, rules, ncols: int, as_of_sql: str) -> str:
    cols = sorted({r.column for r in rules if r.column})
    m = ["count(*) AS total"]
    for c in cols:
        m += [f"count({c}) AS nn_{c}", f"count(DISTINCT {c}) AS d_{c}"]
    sel = []
    for r in rules:
        c = r.column
        if r.kind == "ColumnCount":
            actual, ok = f"{ncols}.0", f"{ncols} = {r.value}"
        elif r.kind == "Completeness":
            actual = f"nn_{c} * 1.0 / nullif(total, 0)"
            ok = f"coalesce({actual} = {float(r.value)}, false)"
        elif r.kind == "DistinctValuesCount":
            actual, ok = f"d_{c} * 1.0", f"d_{c} = {r.value}"
        elif r.kind == "IsComplete":
            actual, ok = f"nn_{c} * 1.0 / nullif(total, 0)", f"nn_{c} = total"
        else:  # IsPrimaryKey
            actual, ok = f"d_{c} * 1.0 / nullif(total, 0)", f"nn_{c} = total AND d_{c} = total"
        exp = "NULL" if r.expected() is None else f"{r.expected()}"
        col = "NULL" if c is None else f"'{c}'"
        sel.append(
            f"SELECT '{r.text()}' AS rule, '{r.kind}' AS rule_type, cast({col} AS VARCHAR) AS \"column\", "
            f"cast({exp} AS DOUBLE) AS expected, cast({actual} AS DOUBLE) AS actual, "
            f"CASE WHEN {ok} THEN 'Passed' ELSE 'Failed' END AS outcome, "
            f"CASE WHEN {ok} THEN NULL ELSE '{r.reason()}' END AS failure_reason, "
            f"{as_of_sql} AS updated_at, strftime({as_of_sql}, '%Y%m%d') AS datekey FROM m")
    return f"WITH {cte}, m AS (SELECT {', '.join(m)} FROM curated)\n" + "\nUNION ALL\n".join(sel)


@register("dq_channel", _dq_sql(_CURATED_CHANNEL_SQL, quality.CHANNEL_RULES, 10, AS_OF_SQL))
def q_dq_channel(spark, sf):
    raw = td.raw_channel(td.load(spark, sf, "customer"), td.load(spark, sf, "nation"))
    return quality.evaluate(clean.curate_channel(raw, AS_OF), quality.CHANNEL_RULES, AS_OF)


@register("dq_video", _dq_sql(_CURATED_VIDEO_SQL, quality.VIDEO_RULES, 20, AS_OF_SQL))
def q_dq_video(spark, sf):
    """Curated videos stored for two days; the rules see only the run day."""
    curated = clean.curate_video(td.raw_video(td.load(spark, sf, "orders")), AS_OF)
    path = scratch_path(spark, "curated_video")
    old = curated.filter(F.col("published_date") < F.lit(DAY1)).withColumn("updated_date", F.lit(DAY1))
    write_days(old, path, "updated_date")
    write_days(curated, path, "updated_date")
    today = read_day(spark, path, schemas.CURATED_VIDEO, AS_OF)
    return quality.evaluate(today, quality.VIDEO_RULES, AS_OF)


@register("dq_channel_from_text", ORACLE["dq_channel"])
def q_dq_channel_from_text(spark, sf):
    """The channel rules as they are written in a job, parsed and evaluated."""
    raw = td.raw_channel(td.load(spark, sf, "customer"), td.load(spark, sf, "nation"))
    return quality.evaluate(clean.curate_channel(raw, AS_OF), rule_text.parse(rule_text.CHANNEL_RULES_TEXT), AS_OF)


def _stored_outcomes(spark, name, outcomes):
    path = scratch_path(spark, name)
    quality.write_outcomes(outcomes, path)
    return read_table(spark, path, schemas.RULE_OUTCOME).select(*schemas.RULE_OUTCOME.fieldNames())


@register("dq_channel_stored", ORACLE["dq_channel"])
def q_dq_channel_stored(spark, sf):
    """Outcomes written as the quality job does, and read back."""
    return _stored_outcomes(spark, "dq_channel", q_dq_channel(spark, sf))


@register("dq_video_stored", ORACLE["dq_video"])
def q_dq_video_stored(spark, sf):
    return _stored_outcomes(spark, "dq_video", q_dq_video(spark, sf))


# ---- the cleaning job over CSV --------------------------------------------

@register("curate_video", f"""
WITH {VIDEO_DIM_SQL}
SELECT video_id, channel_id, published_date, title, description, hashtags, audio_language,
       content_duration_hour, content_duration_minutes, content_duration_seconds,
       virtual_dimension, quality_definition, privacy_status, topic_category,
       cast(floor(o_totalprice) AS BIGINT) AS views_count, cast(0 AS BIGINT) AS likes_count,
       cast(0 AS BIGINT) AS dislikes_count, cast(0 AS BIGINT) AS favorites_count,
       cast(0 AS BIGINT) AS comments_count, updated_date
FROM video_dim JOIN orders ON video_id = cast(o_orderkey AS VARCHAR)
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> '{EXCLUDED_SEGMENT}')""")
def q_curate_video(spark, sf):
    """Raw listing as CSV -> allow-list split (profile observed on the way)
    -> curated day -> read back."""
    root = scratch_path(spark, "clean_video")
    # the listing lands as one file for each part of the table that is read: a
    # multi-line CSV file is read by one task, and so its files follow the bytes
    write_csv(td.raw_video(td.load(spark, sf, "orders")), f"{root}/raw")
    raw = read_csv(spark, f"{root}/raw", schemas.RAW_VIDEO)
    curated = clean.curate_video_profiled(raw, "channel_id", _allowed_channels(spark, sf), AS_OF,
                                          Observation("curate_video"))
    write_days(curated, f"{root}/curated", "updated_date")
    return _joined_tags(read_day(spark, f"{root}/curated", schemas.CURATED_VIDEO, AS_OF)
                        .select(*schemas.CURATED_VIDEO.fieldNames()))


@register("curate_channel", f"WITH {_CURATED_CHANNEL_SQL} SELECT * FROM curated")
def q_curate_channel(spark, sf):
    root = scratch_path(spark, "clean_channel")
    write_csv(td.raw_channel(td.load(spark, sf, "customer"), td.load(spark, sf, "nation")), f"{root}/raw")
    raw = read_csv(spark, f"{root}/raw", schemas.RAW_CHANNEL)
    write_days(clean.curate_channel(raw, AS_OF), f"{root}/curated", "updated_date")
    return (read_day(spark, f"{root}/curated", schemas.CURATED_CHANNEL, AS_OF)
            .select(*schemas.CURATED_CHANNEL.fieldNames()))


# ---- the same reports as Spark SQL text over named tables -----------------



def _sql_report(name, channel=False):
    def fn(spark, sf):
        if channel:
            d, f = _channel(spark, sf)
            sql_reports.register_tables(channel_dim=d, channel_fact=f)
        else:
            d, f = _video(spark, sf)
            sql_reports.register_tables(video_dim=d, video_fact=f)
        return sql_reports.run(spark, name, AS_OF, 12)
    return fn


for _name, _same, _ch in (("top_viewed", "top_viewed", False),
                          ("likes_to_view_ratio", "engagement_ratio", False),
                          ("channel_video_counts", "channel_video_counts", True),
                          ("channel_subscriber_counts", "channel_subscriber_counts", True),
                          ("uploads_per_channel", "trend_channel", False),
                          ("uploads_per_quarter", "trend_quarter", False),
                          ("uploads_per_month", "trend_month", False)):
    register(f"sql_{_name}", ORACLE[_same])(_sql_report(_name, _ch))


# ---- a report over stored tables (the production read path) ---------------

@register("stored_top_viewed", ORACLE["top_viewed"])
def q_stored_top_viewed(spark, sf):
    """The video dimension stored as a committed version and the snapshots as
    day partitions; top-k then reads the newest version (picked by listing)
    and only the newest snapshot day (picked from the folder names)."""
    root = scratch_path(spark, "stored_reports")
    dim, fact = _video(spark, sf)
    dims.load_dimension(spark, f"{root}/video_dim", dim, schemas.VIDEO_DIM, ["video_id"],
                        schemas.VIDEO_DIM_UPDATE, schemas.VIDEO_DIM_COLUMNS, AS_OF)
    facts.write_snapshot(fact.select(*schemas.VIDEO_FACT_COLUMNS), f"{root}/video_fact", rebalance=True)
    vdim = read_latest_version(spark, f"{root}/video_dim", schemas.VIDEO_DIM)
    vfact = facts.read_latest_snapshot(spark, f"{root}/video_fact", schemas.VIDEO_FACT)
    return reports.top_viewed(vdim, vfact, 10)


def _named(spark, sf):
    """Dimensions, and one snapshot of each fact a day, stored and named."""
    out = Layout(scratch_path(spark, "named"))
    vdim, vfact = _video(spark, sf)
    orders = td.load(spark, sf, "orders")
    cdim = td.channel_dim(td.load(spark, sf, "customer"), td.load(spark, sf, "nation"), AS_OF)
    for dim, path, schema, key, update in (
            (vdim, out.video_dim, schemas.VIDEO_DIM, "video_id", schemas.VIDEO_DIM_UPDATE),
            (cdim, out.channel_dim, schemas.CHANNEL_DIM, "channel_id", schemas.CHANNEL_DIM_UPDATE)):
        dims.load_dimension(spark, path, dim, schema, [key], update, schema.names, AS_OF)
    facts.write_snapshot(vfact.select(*schemas.VIDEO_FACT_COLUMNS), out.video_fact, rebalance=True)
    facts.write_snapshot(td.channel_fact(orders).select(*schemas.CHANNEL_FACT_COLUMNS), out.channel_fact, rebalance=True)
    database = f"named_{uuid.uuid4().hex[:12]}"
    sql_reports.name_tables(spark, out, database)
    return database


@register("named_likes_to_view_ratio", ORACLE["sql_likes_to_view_ratio"])
def q_named_ratio(spark, sf):
    """The SQL report over ``database.table`` names of the session catalog; the
    newest day is pruned from the catalog's partitions."""
    return sql_reports.run(spark, "likes_to_view_ratio", database=_named(spark, sf))


@register("named_channel_video_counts", ORACLE["sql_channel_video_counts"])
def q_named_counts(spark, sf):
    return sql_reports.run(spark, "channel_video_counts", database=_named(spark, sf))


@register("bucketed_ratio", ORACLE["sql_likes_to_view_ratio"])
def q_bucketed_ratio(spark, sf):
    """The ratio report over a dimension and a fact stored in the same buckets
    of the video id: the join needs no shuffle, and the newest day's partition is all it reads of the fact."""
    root, database = scratch_path(spark, "bucketed"), f"bucketed_{uuid.uuid4().hex[:12]}"
    dim, fact = _video(spark, sf)
    named.create_database(spark, database, root)
    named.write_bucketed(dim, f"{database}.video_data_dim", f"{root}/dim", "video_id", 16)
    named.write_bucketed(fact.select(*schemas.VIDEO_FACT_COLUMNS), f"{database}.video_data_fact", f"{root}/fact", "video_id", 16, "snapshot_date")
    return sql_reports.run(spark, "likes_to_view_ratio", database=database)


# ---- a dimension laid out by channel ---------------------------------------

@register("dim_by_channel", f"""
WITH {VIDEO_DIM_SQL.replace("@AS_OF", AS_OF_SQL)}
SELECT channel_id, count(*) AS n_videos, min(video_id) AS first_id, max(video_id) AS last_id,
       min(published_date) AS first_date FROM video_dim GROUP BY channel_id""")
def q_dim_by_channel(spark, sf):
    """The video dimension's first load laid out by channel, read back."""
    path = scratch_path(spark, "by_channel")
    dim = td.video_dim(td.load(spark, sf, "orders"), AS_OF).select(*schemas.VIDEO_DIM_COLUMNS)
    write_clustered(dim, path, 20010801, ["channel_id"], "video_id")
    return read_latest_version(spark, path, schemas.VIDEO_DIM).groupBy("channel_id").agg(
        F.count(F.lit(1)).alias("n_videos"), F.min("video_id").alias("first_id"), F.max("video_id").alias("last_id"),
        F.min("published_date").alias("first_date"))


# ---- chains of stored pages --------------------------------------------------

@register("page_chains", """
WITH stored AS (
  SELECT p_partkey AS k, p_partkey // 200 AS listing, p_size % 13 = 0 AS twice FROM part WHERE p_size % 17 <> 0),
marked AS (
  SELECT *, k - row_number() OVER (PARTITION BY listing ORDER BY k) AS run FROM stored)
SELECT cast(listing AS VARCHAR) AS listing, cast(min(k) AS VARCHAR) AS head, count(*) AS n_pages,
       cast(sum(CASE WHEN twice THEN 1 ELSE 0 END) AS BIGINT) AS n_repeated,
       CASE WHEN max(k) % 200 <> 199 THEN cast(max(k) + 1 AS VARCHAR) END AS missing, false AS loops
FROM marked GROUP BY listing, run""")
def q_page_chains(spark, sf):
    """Pages built from ``part``: 200 to a listing, each naming the next; some
    were never stored, some twice. Read back from JSON lines and followed."""
    part, k = td.load(spark, sf, "part").filter(F.col("p_size") % 17 != 0), F.col("p_partkey")
    page = F.to_json(F.struct(
        F.floor(k / 200).cast("string").alias("listing"), k.cast("string").alias("pageToken"),
        F.when(k % 200 != 199, (k + 1).cast("string")).alias("nextPageToken")))
    twice = F.explode(F.when(F.col("p_size") % 13 == 0, F.array(page, page)).otherwise(F.array(page)))
    path = scratch_path(spark, "chain_pages")
    write_json_lines(part.select(twice.alias("value")), path)
    r = F.from_json("value", "listing string, pageToken string, nextPageToken string")
    pages = read_json_lines(spark, path).select(r.alias("r")).select(
        "r.listing", F.col("r.pageToken").alias("token"), F.col("r.nextPageToken").alias("next_token"))
    return page_chains.chains(pages)


# ---- drift of records ----------------------------------------------------------

@register("record_drift", """
WITH r AS (SELECT *, p_size % 5 <> 0 AS titled, p_size % 11 <> 0 AS counted FROM part WHERE p_size % 13 <> 0),
t AS (SELECT count(*) AS n, count(*) FILTER (WHERE titled) AS title, count(*) FILTER (WHERE p_size > 10) AS country,
             count(*) FILTER (WHERE p_size % 3 = 0) AS region, count(*) FILTER (WHERE counted) AS stats,
             count(*) FILTER (WHERE counted AND p_size % 4 = 0) AS videos FROM r),
k AS (
  SELECT '' AS path, true AS declared, true AS required, (SELECT count(*) FROM part) AS n_parents, n AS n_present, 0 AS n_retyped FROM t
  UNION ALL SELECT 'id', true, false, n, n, 0 FROM t
  UNION ALL SELECT 'etag', false, false, n, n, 0 FROM t
  UNION ALL SELECT 'snippet', true, true, n, n, 0 FROM t
  UNION ALL SELECT 'snippet.title', true, true, n, title, 0 FROM t
  UNION ALL SELECT 'snippet.description', true, true, n, n, 0 FROM t
  UNION ALL SELECT 'snippet.publishedAt', true, true, n, n, 0 FROM t
  UNION ALL SELECT 'snippet.defaultLanguage', true, false, n, 0, 0 FROM t
  UNION ALL SELECT 'snippet.country', true, false, n, country, country FROM t
  UNION ALL SELECT 'snippet.region', false, false, n, region, 0 FROM t
  UNION ALL SELECT 'statistics', true, true, n, stats, 0 FROM t
  UNION ALL SELECT 'statistics.viewCount', true, true, stats, stats, 0 FROM t
  UNION ALL SELECT 'statistics.subscriberCount', true, true, stats, stats, 0 FROM t
  UNION ALL SELECT 'statistics.videoCount', true, true, stats, videos, 0 FROM t)
SELECT path, declared, required, n_parents, n_present, cast(0 AS BIGINT) AS n_null, n_parents - n_present AS n_missing,
       cast(n_retyped AS BIGINT) AS n_retyped,
       CASE WHEN NOT declared THEN 'unknown' WHEN required AND n_present < n_parents THEN 'missing'
            WHEN n_retyped > 0 THEN 'retyped' WHEN n_present = 0 THEN 'absent' ELSE 'ok' END AS status
FROM k""")
def q_record_drift(spark, sf):
    """Channel records built from ``part`` that lack keys, hold unknown ones, hold a
    country as a list, or are cut short, against the declared schema."""
    size = F.col("p_size")
    has = lambda when, c, name: F.when(when, c).alias(name)
    record = F.to_json(F.struct(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_brand").alias("etag"),
        F.struct(has(size % 5 != 0, F.col("p_name"), "title"), F.col("p_type").alias("description"),
                 F.lit("2001-08-01T00:00:00Z").alias("publishedAt"),
                 has(size > 10, F.array("p_type"), "country"), has(size % 3 == 0, F.lit("EU"), "region")).alias("snippet"),
        has(size % 11 != 0, F.struct(
            F.floor("p_retailprice").cast("string").alias("viewCount"), size.cast("string").alias("subscriberCount"),
            has(size % 4 == 0, F.lit("1"), "videoCount")), "statistics")))
    path = scratch_path(spark, "drift_records")
    write_json_lines(td.load(spark, sf, "part").select(
        F.when(size % 13 == 0, F.substring(record, 1, 10)).otherwise(record).alias("value")), path)
    return drift.drift(read_json_lines(spark, path), schemas.CHANNEL_API, drift.CHANNEL_OPTIONAL)


# ---- intake of landed files ----------------------------------------------------

@register("intake_twice", """
SELECT cast(o_orderkey AS VARCHAR) AS video_id, 'order-' || cast(o_orderkey AS VARCHAR) AS title,
       CASE WHEN o_orderstatus = 'F' THEN DATE '2001-08-01' ELSE DATE '2001-08-02' END AS updated_date
FROM orders""")
def q_intake_twice(spark, sf):
    """Listings land in two drops; the second day and a rerun of the first are
    offered files that have been taken: every row counts once, on its first day."""
    root, orders = scratch_path(spark, "intake"), td.load(spark, sf, "orders")
    drops = {"d1": F.col("o_orderstatus") == "F", "d2": F.coalesce(F.col("o_orderstatus") != "F", F.lit(True))}
    column, days = "updated_date", (AS_OF, AS_OF + dt.timedelta(days=1))

    def rows(paths):
        raw = read_csv(spark, paths, schemas.RAW_VIDEO) if paths else spark.createDataFrame([], schemas.RAW_VIDEO)
        return raw.select("video_id", "title")
    for drop, day in (("d1", days[0]), ("d2", days[1]), (None, days[0])):
        if drop:
            write_csv(td.raw_video(orders.filter(drops[drop])), f"{root}/landing/{drop}")
        take_day(spark, [f"{root}/landing"], f"{root}/table", f"{root}/ledger", column, day, rows)
    return read_table(spark, f"{root}/table", T.StructType.fromDDL(f"video_id string, title string, {column} date"))
