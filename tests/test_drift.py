"""Keys that records lack, hold beyond the schema, or hold in another form."""

from snapmart.operators import drift
from snapmart.schemas import CHANNEL_API, VIDEO_API


def told(spark, texts, schema=CHANNEL_API, optional=drift.CHANNEL_OPTIONAL):
    rows = drift.drift(spark.createDataFrame([(t,) for t in texts], "value string"), schema, optional).collect()
    assert len({r.path for r in rows}) == len(rows)
    return {r.path: (r.status, r.n_parents, r.n_present, r.n_null, r.n_missing, r.n_retyped) for r in rows}


def test_every_way_to_drift(spark):
    got = told(spark, [
        '{"id": "a", "snippet": {"title": "t", "description": null, "publishedAt": "p", "country": "SG"},'
        ' "statistics": {"viewCount": "1", "subscriberCount": 2, "videoCount": ["3"]}}',
        '{"id": {"x": 1}, "snippet": {"title": "t", "description": "d", "region": {"deep": 1}}, "etag": 1}',
        '{"snippet": "text", "statistics": {}}',
        '{"id": "cut', None, '[1]', '7', '{"id": "a", "id": "b"}',
    ])
    assert got[""] == ("missing", 8, 3, 0, 5, 0)
    assert got["id"] == ("retyped", 3, 2, 0, 1, 1)
    assert got["snippet"] == ("retyped", 3, 3, 0, 0, 1)
    assert got["snippet.title"] == ("ok", 2, 2, 0, 0, 0)
    assert got["snippet.description"] == ("ok", 2, 2, 1, 0, 0)
    assert got["snippet.publishedAt"] == ("missing", 2, 1, 0, 1, 0)
    assert got["snippet.country"] == ("ok", 2, 1, 0, 1, 0)
    assert got["snippet.defaultLanguage"] == ("absent", 2, 0, 0, 2, 0)
    assert got["snippet.region"] == ("unknown", 2, 1, 0, 1, 0) and "snippet.region.deep" not in got
    assert got["statistics"] == ("missing", 3, 2, 0, 1, 0)
    assert got["statistics.videoCount"] == ("missing", 2, 1, 0, 1, 1)
    assert got["etag"] == ("unknown", 3, 1, 0, 2, 0)


def test_three_levels_and_no_records(spark):
    got = told(spark, ['{"id": "v", "snippet": {"localized": {"defaultAudioLanguage": "en", "title": "t"}, "tags": ["a"]}}'],
               VIDEO_API, drift.VIDEO_OPTIONAL)
    assert got["snippet.localized.defaultAudioLanguage"][0] == "ok" and got["snippet.tags"][0] == "ok"
    assert got["snippet.localized.title"] == ("unknown", 1, 1, 0, 0, 0)
    assert got["topicDetails.topicCategories"] == ("absent", 0, 0, 0, 0, 0)  # required only where its parent is
    empty = told(spark, [])
    assert empty.pop("") == ("absent", 0, 0, 0, 0, 0) and {r[0] for r in empty.values()} == {"absent"}


def test_merged_schema(spark):
    rows = spark.createDataFrame([('{"a": 1}',), ('{"b": ["x"]}',), (None,)], "value string")
    assert drift.merged_schema(rows).first().schema == "OBJECT<a: BIGINT, b: ARRAY<STRING>>"
