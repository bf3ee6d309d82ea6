"""Scalar functions, cleaning and flattening edge rows."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions import duration_part, safe_ratio, topic_names, url_tail
from snapmart.operators import clean, flatten


def test_durations(spark):
    cases = {"PT1H2M3S": (1, 2, 3), "PT2M": (0, 2, 0), "PT05M": (0, 5, 0), "PT0S": (0, 0, 0),
             "P1DT2H": (0, 0, 0), "P0D": (0, 0, 0), "": (0, 0, 0), None: (0, 0, 0)}
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    got = {r.d: (r.h, r.m, r.s) for r in df.select(
        "d", duration_part("d", "hour").alias("h"), duration_part("d", "minutes").alias("m"),
        duration_part("d", "seconds").alias("s")).collect()}
    assert got == cases


def test_allow_list_split_partitions_input(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    ok, bad = clean.split_allowed(df, "c", ["a", "b"])
    assert [r.c for r in ok.collect()] == ["a"]
    assert sorted(r.c or "-" for r in bad.collect()) == ["-", "z"]
    ok2, bad2 = clean.split_allowed(df, "c", df.sparkSession.createDataFrame([("a",)], "c string"))
    assert ok2.count() == 1 and bad2.count() == 2


def test_profile_counts_null_and_null_text(spark):
    df = spark.createDataFrame([("a", "xNULLx", None), ("a", None, 1), ("a", "ok", 2), ("z", None, None)],
                               "c string, s string, n int")
    r = clean.profile(df, "c", ["a"]).collect()[0]
    assert (r.c, r.s, r.n, r.corrupt_records) == (0, 2, 1, 1)


def test_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 4)], "a long, b long")
    assert [r.x for r in df.select(safe_ratio("a", "b").alias("x")).collect()] == [None, None, 0.25]


def test_url_tail_and_topics(spark):
    df = spark.createDataFrame([("https://host/wiki/Music", ["https://h/wiki/A", "https://h/wiki/B"]),
                                ("https://host/x/", None)], "u string, t array<string>")
    got = df.select(url_tail("u").alias("u"), topic_names("t").alias("t")).collect()
    assert [(r.u, r.t) for r in got] == [("Music", "A,B"), ("", "")]


def test_video_record_defaults(spark):
    rec = {"id": "v", "snippet": {"channelId": "c", "publishedAt": "2024-01-01T00:00:00Z",
                                  "title": "t", "description": "d", "localized": {}},
           "contentDetails": {"duration": "PT1M", "dimension": "2d", "definition": "hd"},
           "status": {"privacyStatus": "public"},
           "statistics": {"viewCount": "10", "likeCount": "2", "favoriteCount": "0"}}
    full = dict(rec, snippet=dict(rec["snippet"], tags=["x", "y"], localized={"defaultAudioLanguage": "de"}),
                topicDetails={"topicCategories": ["https://en.wikipedia.org/wiki/Music"]})
    df = spark.createDataFrame([(json.dumps(rec),), (json.dumps(full),)], "value string")
    a, b = sorted(flatten.flatten_videos(df).collect(), key=lambda r: r.hashtags)
    assert (a.hashtags, a.topic_category, a.dislikes_count, a.comments_count, a.audio_language) == \
        ("", "", 0, 0, "en")
    assert (b.hashtags, b.topic_category, b.audio_language, b.views_count) == ("x,y", "Music", "de", 10)


def test_channel_record_defaults_and_pages(spark):
    ch = {"id": "c1", "snippet": {"title": "t", "description": "d", "publishedAt": "p"},
          "statistics": {"viewCount": "5000000000", "subscriberCount": "1", "videoCount": "2"}}
    pages = [{"items": [ch, dict(ch, id="c2")]}, {"items": []}]
    df = spark.createDataFrame([(json.dumps(p),) for p in pages], "value string")
    first = flatten.channel_pages(df, first_only=True).collect()
    assert [(r.channel_id, r.default_language, r.country, r.views_count) for r in first] == \
        [("c1", "en", "global", 5_000_000_000)]
    assert flatten.channel_pages(df, first_only=False).count() == 2


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from(list("abcde"))), max_size=20),
       st.lists(st.sampled_from(list("abcxyz")), max_size=4))
def test_split_parts_partition_the_input(spark, values, allow):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, c string")
    ok, bad = clean.split_allowed(df, "c", allow)
    a, b = {r.i for r in ok.collect()}, {r.i for r in bad.collect()}
    assert a.isdisjoint(b) and a | b == set(range(len(values)))
    labelled = {r.i: r.part for r in clean.label_allowed(df, "c", allow).collect()}
    assert {i for i, p in labelled.items() if p == "clean"} == a


def test_pages_from_json_lines_files(spark, tmp_path):
    from snapmart.sources import read_json_lines
    ch = {"id": "c1", "snippet": {"title": "t", "description": "line\nbreak", "publishedAt": "p"},
          "statistics": {"viewCount": "1", "subscriberCount": "2", "videoCount": "3"}}
    for i in range(3):
        (tmp_path / f"page-{i}.jsonl").write_text(
            json.dumps({"items": [dict(ch, id=f"c{i}")]}) + "\n" + json.dumps({"items": []}) + "\n")
    rows = flatten.channel_pages(read_json_lines(spark, str(tmp_path)), first_only=False).collect()
    assert sorted(r.channel_id for r in rows) == ["c0", "c1", "c2"]
    assert rows[0].description == "line\nbreak"


def test_profile_observed_during_curation_equals_profile(spark):
    import datetime as dt

    from pyspark.sql import Observation
    from snapmart import schemas
    rows = [("v1", "a", "2024-01-01", None, "xNULLx", None, "en", "PT1M", "2d", "hd", "p", "m", 1, 2, 3, 4, 5),
            ("v2", "z", "2024-01-01", "t", "d", "h", "en", "PT1M", "2d", "hd", "p", "m", 1, None, 3, 4, 5),
            ("v3", None, "bad", "t", "d", "h", None, "", "2d", "hd", "p", "m", 1, 2, 3, 4, 5)]
    raw = spark.createDataFrame(rows, schemas.RAW_VIDEO)
    obs = Observation("p")
    cur = clean.curate_video_profiled(raw, "channel_id", ["a"], dt.date(2024, 1, 2), obs)
    assert [r.video_id for r in cur.collect()] == ["v1"]
    assert obs.get == clean.profile(raw, "channel_id", ["a"]).collect()[0].asDict()


def test_curate_channel_bad_date_text_is_null(spark):
    import datetime as dt
    raw = spark.createDataFrame([("c", "t", "d", "unknown", "en", "SG", 1, 2, 3),
                                 ("d", "t", "d", "2024-01-01T23:30:00Z", "en", "SG", 1, 2, 3)],
                                "channel_id string, title string, description string, published_at string, "
                                "default_language string, country string, views_count long, "
                                "subscribers_count long, videos_count long")
    got = {r.channel_id: r.published_date for r in clean.curate_channel(raw, dt.date(2024, 1, 2)).collect()}
    assert got == {"c": None, "d": dt.date(2024, 1, 1)}


def test_input_bytes_with_glob(spark):
    from snapmart.session import input_bytes
    whole = input_bytes(spark, "/root/testdata/sf0.001")
    assert 0 < input_bytes(spark, "/root/testdata/sf0.001/*.parquet") == whole


def test_video_pages_explode_every_item(spark):
    v = {"id": "v1", "snippet": {"channelId": "c", "publishedAt": "2024-01-01T00:00:00Z", "title": "t",
                                 "description": "d", "localized": {}},
         "contentDetails": {"duration": "PT1M", "dimension": "2d", "definition": "hd"},
         "status": {"privacyStatus": "public"},
         "statistics": {"viewCount": "10", "likeCount": "2", "favoriteCount": "0"}}
    pages = [{"items": [v, dict(v, id="v2")]}, {"items": []}, {"items": [dict(v, id="v3")]}]
    df = spark.createDataFrame([(json.dumps(p),) for p in pages], "value string")
    got = flatten.video_pages(df).collect()
    assert sorted(r.video_id for r in got) == ["v1", "v2", "v3"]
    assert len(got[0]) == 17
    ids = flatten.distinct_ids(flatten.video_pages(df.union(df)), "video_id")
    assert ids.count() == 3
