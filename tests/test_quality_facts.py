"""Quality outcomes and fact snapshots."""

import datetime as dt

from snapmart import schemas
from snapmart.operators import facts, quality, reports

AS_OF = dt.date(2024, 1, 2)


def outcomes(spark, rows, rules):
    df = spark.createDataFrame(rows, "k string, d date")
    return {r.rule: r for r in quality.evaluate(df, rules, AS_OF).collect()}


def test_null_and_repeated_keys(spark):
    rows = [("a", AS_OF), ("a", AS_OF), (None, AS_OF), ("b", None)]
    got = outcomes(spark, rows, [quality.Completeness("k", 1.0), quality.IsPrimaryKey("k"),
                                 quality.DistinctValuesCount("k", 2), quality.IsComplete("d"),
                                 quality.ColumnCount(value=2)])
    assert got['Completeness "k" = 1'].outcome == "Failed"
    assert got['Completeness "k" = 1'].actual == 0.75
    assert got['IsPrimaryKey "k"'].outcome == "Failed"
    assert got['DistinctValuesCount "k" = 2'].outcome == "Passed"
    assert got['IsComplete "d"'].outcome == "Failed"
    assert got["ColumnCount = 2"].outcome == "Passed"
    r = got["ColumnCount = 2"]
    assert (r.updated_at, r.datekey) == (AS_OF, "20240102")


def test_primary_key_passes_per_day_only(spark):
    both_days = [("a", dt.date(2024, 1, 1)), ("a", AS_OF), ("b", AS_OF)]
    df = spark.createDataFrame(both_days, "k string, d date")
    pk = [quality.IsPrimaryKey("k")]
    assert quality.evaluate(df, pk).collect()[0].outcome == "Failed"
    assert quality.evaluate(df.filter(df.d == AS_OF), pk).collect()[0].outcome == "Passed"


def test_snapshot_latest_and_string_key(spark, tmp_path):
    cur = spark.createDataFrame([("v", "c", 1, 2, 0, 0, 3)],
                                "video_id string, channel_id string, views_count long, likes_count long, "
                                "dislikes_count long, favorites_count long, comments_count long")
    path = str(tmp_path / "f")
    for day in (dt.date(2024, 1, 1), AS_OF, AS_OF):
        facts.write_snapshot(facts.video_snapshot(cur, day), path)
    stored = facts.read_snapshots(spark, path, schemas.VIDEO_FACT)
    assert dict(stored.dtypes)["snapshot_date"] == "string"
    assert stored.count() == 2
    assert [r.snapshot_date for r in reports.latest(stored).collect()] == ["20240102"]


def test_latest_snapshot_from_folder_names_equals_max_filter(spark, tmp_path):
    cur = spark.createDataFrame([("v", "c", 1, 2, 0, 0, 3), ("w", "c", 5, 2, 0, 0, 3)],
                                "video_id string, channel_id string, views_count long, likes_count long, "
                                "dislikes_count long, favorites_count long, comments_count long")
    path = str(tmp_path / "f")
    for day in (dt.date(2023, 12, 31), dt.date(2024, 1, 1), AS_OF):
        facts.write_snapshot(facts.video_snapshot(cur, day), path)
    a = facts.read_latest_snapshot(spark, path, schemas.VIDEO_FACT)
    b = reports.latest(facts.read_snapshots(spark, path, schemas.VIDEO_FACT))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert {r.snapshot_date for r in a.collect()} == {"20240102"}


def test_latest_snapshot_ignores_null_key_partition(spark, tmp_path):
    cur = spark.createDataFrame([("v", "c", 1, 2, 0, 0, 3)],
                                "video_id string, channel_id string, views_count long, likes_count long, "
                                "dislikes_count long, favorites_count long, comments_count long")
    path = str(tmp_path / "f")
    facts.write_snapshot(facts.video_snapshot(cur, AS_OF), path)
    facts.write_snapshot(cur.withColumn("snapshot_date", __import__("pyspark.sql.functions", fromlist=["lit"])
                                        .lit(None).cast("string")), path)
    got = facts.read_latest_snapshot(spark, path, schemas.VIDEO_FACT).collect()
    assert [r.snapshot_date for r in got] == ["20240102"]
