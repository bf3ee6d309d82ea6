"""Reports over catalog names, and a dimension laid out by channel."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.operators import dims, facts
from snapmart.plans import sql_reports
from snapmart.plans.daily import Layout
from snapmart.sources import named, read_latest_version
from snapmart.sources.tables import write_clustered, write_version

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def rows_for(spark, schema, n, **values):
    df = spark.range(n).select(F.col("id").cast("string").alias("i"))
    ids = {"video_id": F.col("i"), "channel_id": F.col("i"), "published_date": F.lit(DAYS[0])}
    return df.select(*[values.get(f.name, ids.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in schema.fields])


def store(spark, out, day, views, n=20):
    for path, schema, key in ((out.video_dim, schemas.VIDEO_DIM, "video_id"), (out.channel_dim, schemas.CHANNEL_DIM, "channel_id")):
        dims.load_dimension(spark, path, rows_for(spark, schema, n, title=F.lit(f"t{day}")), schema, [key], ["title"], schema.names, day, buckets=4)
    for path, schema in ((out.video_fact, schemas.VIDEO_FACT), (out.channel_fact, schemas.CHANNEL_FACT)):
        df = rows_for(spark, schema, n, views_count=F.lit(views), videos_count=F.lit(views), snapshot_date=F.lit(day.strftime("%Y%m%d")))
        facts.write_snapshot_day(df, path, day)


def test_reports_by_name_follow_what_is_published(spark, tmp_path):
    out, db = Layout(str(tmp_path / "o'ut")), "named_test"
    store(spark, out, DAYS[0], 1)
    sql_reports.name_tables(spark, out, db)
    counts = lambda: {r.videos_count for r in sql_reports.run(spark, "channel_video_counts", database=db).collect()}
    assert counts() == {1}
    store(spark, out, DAYS[1], 2)
    assert counts() == {1}  # published, not yet named
    sql_reports.name_tables(spark, out, db)
    assert counts() == {2}
    store(spark, out, DAYS[1], 5)  # the day again
    sql_reports.name_tables(spark, out, db)
    assert counts() == {5} and spark.table(f"{db}.channel_data_fact").count() == 40
    store(spark, out, DAYS[2], 9, n=0)  # a day without rows has no partition
    files = len(glob.glob(f"{out.root}/channel_fact/*/*/*.parquet"))
    sql_reports.name_tables(spark, out, db)
    assert counts() == {5} and named.newest_day(spark, f"{db}.channel_data_fact") == "20240102"
    assert len(glob.glob(f"{out.root}/channel_fact/*/*/*.parquet")) == files
    named.place(spark, f"{db}.channel_data_fact", "snapshot_date", {})  # entries go, files stay
    assert counts() == set() and len(glob.glob(f"{out.root}/channel_fact/*/*/*.parquet")) == files
    top = sql_reports.run(spark, "top_viewed", database=db).collect()
    assert len(top) == 20 and {r.title for r in top} == {f"t{DAYS[1]}"}
    for name in ("uploads_per_channel", "uploads_per_quarter", "uploads_per_month"):
        assert len(sql_reports.run(spark, name, DAYS[2], database=db).collect()) == 20


@pytest.mark.parametrize("name", ["top_viewed", "likes_to_view_ratio", "channel_video_counts"])
def test_only_the_newest_day_is_scanned(spark, tmp_path, name):
    out, db = Layout(str(tmp_path)), f"named_prune_{name}"
    for day in DAYS[:2]:
        store(spark, out, day, 3)
    sql_reports.name_tables(spark, out, db)
    for f in glob.glob(f"{out.root}/*_fact/snapshot_date=20240101/*/*.parquet"):
        with open(f, "wb") as spoiled:  # reading the older day would fail
            spoiled.write(b"no parquet")
    df = sql_reports.run(spark, name, database=db)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "ubquery" not in plan
    assert len(df.collect()) == 20


def scanned(spark, df, metric="numOutputRows"):
    """A metric of the file scan of a frame that has one."""
    df._jdf.queryExecution().executedPlan()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    while plan.children().size():
        plan = plan.children().head()
    if plan.getClass().getSimpleName().startswith("AdaptiveSparkPlan"):
        plan = plan.executedPlan()
        while plan.children().size():
            plan = plan.children().head()
    return plan.metrics().apply(metric).value()


def test_a_channel_is_read_from_few_row_groups(spark, tmp_path):
    n = 60_000  # half of all videos in one channel, the others in 300
    channel = F.when(F.col("i").cast("int") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("i").cast("int") % 601))
    dim = rows_for(spark, schemas.VIDEO_DIM, n, channel_id=channel, title=F.sha2("i", 256)).repartition(8)
    plain, laid = str(tmp_path / "plain"), str(tmp_path / "laid")
    write_version(dim, plain, 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clustered(dim, laid, 1, ["channel_id"], "video_id", row_group=256 << 10)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(f"{laid}/version=1/*.parquet")) <= 8  # not one for each channel
    before, after = (read_latest_version(spark, p, schemas.VIDEO_DIM) for p in (plain, laid))
    assert after.exceptAll(before).isEmpty() and after.count() == n
    one = F.col("channel_id") == "c7"
    assert scanned(spark, before.filter(one)) == n
    assert scanned(spark, after.filter(one)) <= n / 4
    assert after.filter(one).count() == before.filter(one).count() > 0
    by_id = after.filter(F.col("video_id") == "4242")  # ids lie in every file; the bloom filters rule files out
    assert scanned(spark, by_id) <= n / 2 and by_id.count() == 1


def test_equal_buckets_join_without_a_shuffle(spark, tmp_path):
    named.create_database(spark, "named_buckets", str(tmp_path / "db"))
    dim = rows_for(spark, schemas.VIDEO_DIM, 500, title=F.lit("t"))
    fact = rows_for(spark, schemas.VIDEO_FACT, 400, views_count=F.lit(4), likes_count=F.lit(1), snapshot_date=F.lit("20240101"))
    fact = fact.union(fact.withColumns({"snapshot_date": F.lit("20240102"), "likes_count": F.lit(2).cast("long")}))
    named.write_bucketed(dim, "named_buckets.video_data_dim", str(tmp_path / "dim"), "video_id", 4)
    named.write_bucketed(fact, "named_buckets.video_data_fact", str(tmp_path / "fact"), "video_id", 4, "snapshot_date")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = sql_reports.run(spark, "likes_to_view_ratio", database="named_buckets")
        plan = report._jdf.queryExecution().executedPlan().toString()
        rows = report.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in join.split("== Initial Plan")[0] and "snapshot_date" in join
    assert len(rows) == 400 and {r.like_to_view_ratio for r in rows} == {0.5}
    files = glob.glob(f"{tmp_path}/fact/snapshot_date=20240102/*.parquet")
    assert len(files) == 4
