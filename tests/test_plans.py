"""Plans: JSON is parsed once, SQL reports over stored facts read the newest day alone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.operators import flatten
from snapmart.plans import sql_reports

RECORDS = ['{"id": "a", "snippet": {"title": "t"}, "statistics": {"viewCount": "3"}}', "{broken", None]
PAGES = ['{"items": [{"id": "a"}, {"id": "b"}]}', '{"items": []}', "{broken", None]


@pytest.mark.parametrize("name,texts,ids", [
    ("flatten_channels", RECORDS, ["a"]), ("flatten_videos", RECORDS, ["a"]), ("video_pages", PAGES, ["a", "b"]), ("channel_pages", PAGES, ["a"])])
def test_json_is_parsed_once(spark, name, texts, ids):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    out = getattr(flatten, name)(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1, plan
    assert sorted(r[0] for r in out.collect()) == ids


@pytest.mark.parametrize("name", ["top_viewed", "likes_to_view_ratio", "channel_video_counts", "channel_subscriber_counts"])
def test_sql_reports_prune_to_the_newest_day(spark, tmp_path, name):
    days = spark.range(3).select(F.date_format(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")), "yyyyMMdd").alias("snapshot_date"))
    ids = spark.range(40).select(F.col("id").cast("string").alias("video_id"), F.col("id").cast("string").alias("channel_id"))
    paths = {}
    for table, schema in (("video", schemas.VIDEO_FACT), ("channel", schemas.CHANNEL_FACT)):
        rows = ids.crossJoin(days).select(*[F.col(f.name) if f.name in ("video_id", "channel_id", "snapshot_date")
                                            else F.col("video_id").cast(f.dataType).alias(f.name) for f in schema.fields])
        paths[table] = str(tmp_path / table)
        rows.write.partitionBy("snapshot_date").parquet(paths[table])
    vdim = ids.select("*", F.lit("t").alias("title"), F.lit(dt.date(2024, 1, 1)).alias("published_date"))
    sql_reports.register_tables(vdim, spark.read.schema(schemas.VIDEO_FACT).parquet(paths["video"]),
                                vdim.drop("video_id"), spark.read.schema(schemas.CHANNEL_FACT).parquet(paths["channel"]))
    out = sql_reports.run(spark, name)
    plan = out._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters:")[1].split("]")[0] for line in plan.splitlines() if "PartitionFilters:" in line]
    assert any("snapshot_date" in f and "ubquery" in f for f in filters), plan
    assert len(out.collect()) == (10 if name == "top_viewed" else 40)
