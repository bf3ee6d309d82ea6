"""CSV quoting, BOM, blank lines, 64-bit counts, partitioned day writes."""

import glob
import datetime as dt

from pyspark.sql import types as T

from snapmart import schemas
from snapmart.operators import clean
from snapmart.sources import read_csv, read_day, read_table, write_csv, write_day, write_days

HEADER = ",".join(f.name for f in schemas.RAW_VIDEO.fields)


def test_quoted_comma_newline_bom_blank_line(spark, tmp_path):
    p = tmp_path / "v.csv"
    row1 = ('v1,UC_WgSFSkn7112rmJQcHSUIQ,2024-01-01T23:30:00Z,"He said ""hi"", ok","line one\n'
            'line two",a,en,PT1H2M3S,2d,hd,public,Music,5000000000,1,0,0,2')
    row2 = "v2,c2,bad,t,d,,en,PT05M,2d,hd,public,,1,1,1,1,1"
    p.write_text("﻿" + HEADER + "\n" + row1 + "\n\n" + row2 + "\n", encoding="utf-8")
    rows = read_csv(spark, str(p), schemas.RAW_VIDEO).orderBy("video_id").collect()
    assert len(rows) == 2
    r1, r2 = rows
    assert r1.video_id == "v1" and r1.title == 'He said "hi", ok'
    assert r1.description == "line one\nline two"
    assert r1.views_count == 5_000_000_000
    assert r2.hashtags is None
    cur = {r.video_id: r for r in clean.curate_video(
        read_csv(spark, str(p), schemas.RAW_VIDEO), dt.date(2024, 1, 2)).collect()}
    assert cur["v1"].published_date == dt.date(2024, 1, 1)
    assert cur["v2"].published_date is None and cur["v2"].hashtags is None
    assert (cur["v1"].content_duration_hour, cur["v1"].content_duration_minutes,
            cur["v1"].content_duration_seconds) == (1, 2, 3)


def test_write_then_read_keeps_text(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
    data = [(1, ' lead and trail  '), (2, 'a "q", b\r\nc'), (3, ""), (4, None)]
    write_csv(spark.createDataFrame(data, schema), str(tmp_path / "out"))
    back = sorted(tuple(r) for r in read_csv(spark, str(tmp_path / "out"), schema).collect())
    # an empty string reads back as null, as in the listing CSVs themselves
    assert back == [(1, ' lead and trail  '), (2, 'a "q", b\r\nc'), (3, None), (4, None)]


def test_same_day_written_twice_keeps_second_write(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("d", T.DateType())])
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    path = str(tmp_path / "t")
    write_days(spark.createDataFrame([("a", d1), ("b", d2)], schema), path, "d")
    write_days(spark.createDataFrame([("c", d2)], schema), path, "d")
    assert sorted(r.k for r in spark.read.schema(schema).parquet(path).collect()) == ["a", "c"]
    assert [r.k for r in read_day(spark, path, schema, d2, "d").collect()] == ["c"]


def test_backfill_files_follow_the_bytes_of_a_day(spark, tmp_path):
    import os
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        files = []
        for n in (2_000, 80_000):
            big = "cast(if(id % 10 < 8, 0, id % 3) as string) as d"
            df = spark.range(0, n, 1, 8).selectExpr("id", "sha2(cast(id as string), 256) as t", big)
            path = str(tmp_path / f"t{n}")
            write_days(df, path, "d", rebalance=True)
            files.append(len([f for f in os.listdir(f"{path}/d=0") if f.endswith(".parquet")]))
            assert spark.read.parquet(path).count() == n
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert files[0] <= 8 and files[1] > 2 * files[0]  # a large day is written by more tasks


def test_a_day_can_be_replaced_by_nothing(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("d", T.DateType())])
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    path = str(tmp_path / "t")
    for day, rows in ((d1, [("a", d1)]), (d2, [("b", d2)]), (d2, [])):
        write_day(spark.createDataFrame(rows, schema), path, "d", day)
    assert [tuple(r) for r in read_table(spark, path, schema).collect()] == [("a", d1)]


def test_old_versions_expire(spark, tmp_path):
    from snapmart.sources.tables import expire_versions, stored_versions, write_version
    path = str(tmp_path / "dim")
    for v in (20240101, 20240102, 20240103):
        write_version(spark.range(1), path, v)
    assert expire_versions(spark, path, keep=2) == [20240101]
    assert stored_versions(spark, path) == [20240102, 20240103]


def test_size_shuffle_partitions(spark):
    from snapmart.session import size_shuffle_partitions
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = size_shuffle_partitions(spark, "/root/testdata/sf0.01", bytes_per_partition=1 << 20)
        assert n >= spark.sparkContext.defaultParallelism
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_byte_order_mark(spark, tmp_path):
    path = str(tmp_path / "bom")
    df = spark.createDataFrame([("a", "ü"), ("b", None)], "id string, name string")
    write_csv(df, path, bom=True)
    files = glob.glob(f"{path}/*.csv")
    assert files and all(open(f, "rb").read().startswith(b"\xef\xbb\xbfid,name\n") for f in files)
    assert sorted(map(tuple, read_csv(spark, path, df.schema).collect())) == [("a", "ü"), ("b", None)]
