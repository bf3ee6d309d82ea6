"""The daily run over two days, then a rerun of the second day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.operators import reports
from snapmart.plans import daily
from snapmart.plans.daily import Layout, run_day
from snapmart.sources import read_latest_version, read_table, write_csv
from snapmart.sources import testdata as td
from tests.conftest import SF0001

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _raw(spark, tmp, day, title_suffix):
    orders = td.load(spark, SF0001, "orders")
    vid = td.raw_video(orders).withColumn("title", F.concat("title", F.lit(title_suffix)))
    ch = td.raw_channel(td.load(spark, SF0001, "customer"), td.load(spark, SF0001, "nation"))
    write_csv(vid, f"{tmp}/raw/{day}/video")
    write_csv(ch, f"{tmp}/raw/{day}/channel")
    return f"{tmp}/raw/{day}/channel", f"{tmp}/raw/{day}/video"


def test_two_days_and_rerun(spark, tmp_path):
    tmp = str(tmp_path)
    orders = td.load(spark, SF0001, "orders")
    allow = orders.select(F.col("o_custkey").cast("string").alias("channel_id")).distinct()
    out = Layout(f"{tmp}/out")
    n_videos = orders.count()
    ch1, v1 = _raw(spark, tmp, "d1", "")
    ch2, v2 = _raw(spark, tmp, "d2", "-new")
    profile = run_day(spark, ch1, v1, out.root, D1, allow)
    assert profile["corrupt_records"] == 0 and profile["video_id"] == 0
    for _ in range(2):  # second day, then its rerun
        run_day(spark, ch2, v2, out.root, D2, allow)
        dim = read_latest_version(spark, out.video_dim, schemas.VIDEO_DIM)
        assert dim.count() == n_videos
        assert dim.filter(~F.col("title").endswith("-new")).count() == 0
        fact = read_table(spark, out.video_fact, schemas.VIDEO_FACT)
        assert fact.count() == 2 * n_videos
        assert reports.latest(fact).count() == n_videos
        dq = read_table(spark, out.dq_video, schemas.RULE_OUTCOME)
        assert dq.filter(F.col("updated_at") == D2).count() == len(__import__(
            "snapmart.operators.quality", fromlist=["VIDEO_RULES"]).VIDEO_RULES)
    assert {r.datekey for r in dq.collect()} == {"20240101", "20240102"}
    from snapmart.plans.daily import stored_reports
    rep = stored_reports(spark, out.root, D2)
    assert set(rep) >= {"top_viewed", "engagement_ratio", "uploads_per_month"}
    assert rep["engagement_ratio"].count() == n_videos
    assert rep["top_viewed"].count() >= 10
    assert rep["channel_video_counts"].count() > 0


def test_json_pages_to_daily_tables(spark, tmp_path):
    import json

    from snapmart.operators import flatten
    from snapmart.sources import read_json_lines
    tmp = str(tmp_path)
    ch = lambda i: {"id": f"UC{i}", "snippet": {"title": f"ch{i}", "description": "d",
                                                "publishedAt": "2020-05-01T10:00:00Z"},
                    "statistics": {"viewCount": "5000000000", "subscriberCount": "3", "videoCount": "2"}}
    vid = lambda i, c: {"id": f"v{i}", "snippet": {"channelId": c, "publishedAt": "2023-12-31T23:59:59Z",
                                                   "title": f"t{i}", "description": 'say "hi",\nok',
                                                   "tags": ["a", "b"], "localized": {}},
                        "contentDetails": {"duration": "PT1H2M3S", "dimension": "2d", "definition": "hd"},
                        "status": {"privacyStatus": "public"},
                        "statistics": {"viewCount": "10", "likeCount": "2", "favoriteCount": "0"}}
    (tmp_path / "ch.jsonl").write_text("\n".join(json.dumps({"items": [ch(i)]}) for i in range(2)) + "\n")
    (tmp_path / "v.jsonl").write_text(json.dumps({"items": [vid(0, "UC0"), vid(1, "UC1"), vid(2, "X")]}) + "\n")
    write_csv(flatten.channel_pages(read_json_lines(spark, f"{tmp}/ch.jsonl")), f"{tmp}/raw/channel")
    write_csv(flatten.video_pages(read_json_lines(spark, f"{tmp}/v.jsonl")), f"{tmp}/raw/video")
    out = Layout(f"{tmp}/out")
    profile = run_day(spark, f"{tmp}/raw/channel", f"{tmp}/raw/video", out.root, D1, ["UC0", "UC1"])
    assert profile["corrupt_records"] == 1
    vdim = read_latest_version(spark, out.video_dim, schemas.VIDEO_DIM).orderBy("video_id").collect()
    assert [r.video_id for r in vdim] == ["v0", "v1"]
    r = vdim[0]
    assert (r.description, r.hashtags, r.published_date) == ('say "hi",\nok', ["a", "b"], dt.date(2023, 12, 31))
    assert (r.content_duration_hour, r.content_duration_minutes, r.content_duration_seconds) == (1, 2, 3)
    cfact = read_table(spark, out.channel_fact, schemas.CHANNEL_FACT).collect()
    assert {(c.channel_id, c.views_count, c.snapshot_date) for c in cfact} == \
        {("UC0", 5_000_000_000, "20240101"), ("UC1", 5_000_000_000, "20240101")}


def test_rerun_without_rows_leaves_the_day_empty(spark, tmp_path):
    from pyspark.sql import functions as F  # noqa: F811
    tmp = str(tmp_path)
    ch, v = _raw(spark, tmp, "d", "")
    out = Layout(f"{tmp}/out")
    allow = td.load(spark, SF0001, "orders").select(F.col("o_custkey").cast("string").alias("channel_id"))
    run_day(spark, ch, v, out.root, D1, allow)
    run_day(spark, ch, v, out.root, D2, allow)
    run_day(spark, ch, v, out.root, D2, ["none"])  # every video rejected this time
    for table, schema in ((out.curated_video, schemas.CURATED_VIDEO), (out.video_fact, schemas.VIDEO_FACT)):
        stored = read_table(spark, table, schema)
        day = "updated_date" if "updated_date" in stored.columns else "snapshot_date"
        assert stored.select(day).distinct().count() == 1


def test_broken_lines_never_reach_a_dimension(spark, tmp_path):
    from snapmart.operators import flatten
    lines = spark.createDataFrame([('{"id":"a","snippet":{"title":"t"}}',), ("{bad",), ('{"items":',), (None,)], "value string")
    assert [r.channel_id for r in flatten.flatten_channels(lines).collect()] == ["a"]
    good, bad = flatten.split_readable(lines, "value", schemas.CHANNEL_API)
    assert (good.count(), bad.count()) == (1, 3)


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    """``main`` parses its parameters and runs the day; the partitions are sized for the run."""
    tmp = str(tmp_path)
    ch, v = _raw(spark, tmp, "d1", "")
    allow = [r[0] for r in td.load(spark, SF0001, "orders").select(F.col("o_custkey").cast("string")).distinct().limit(3).collect()]
    monkeypatch.setattr("snapmart.session.build_session", lambda: spark)
    monkeypatch.setattr(spark, "stop", lambda: None, raising=False)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        daily.main(["--raw-channel", ch, "--raw-video", v, "--out", f"{tmp}/out", "--as-of", "2024-01-01", "--allow", ",".join(allow)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    out = Layout(f"{tmp}/out")
    dim = read_latest_version(spark, out.video_dim, schemas.VIDEO_DIM)
    want = td.load(spark, SF0001, "orders").filter(F.col("o_custkey").cast("string").isin(allow)).count()
    assert dim.count() == want and {r[0] for r in dim.select("channel_id").distinct().collect()} == set(allow)
    assert read_table(spark, out.dq_video, schemas.RULE_OUTCOME).count() > 0
    assert "corrupt_records" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        daily.main(["--raw-channel", ch])
