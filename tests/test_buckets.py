"""Dimensions in buckets: a merge reads and writes the buckets that hold a key of the day."""

import datetime as dt
import glob
import os

from snapmart.operators.dims import load_dimension, scd1_merge
from snapmart.sources import tables

D = [dt.date(2024, 1, d) for d in range(1, 6)]
SCHEMA_TEXT = "id string, title string, kept string, updated_date date"
ARGS = {"keys": ["id"], "update": ["title", "updated_date"], "insert": ["id", "title", "kept", "updated_date"]}


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA_TEXT)


def load(spark, path, rows, day, buckets=8, **more):
    df = frame(spark, rows)
    return load_dimension(spark, path, df, df.schema, as_of=day, buckets=buckets, **ARGS, **more)


def row(i, title, day):
    return (i if i is None else str(i), title, f"kept-{title}", day)


def data_bytes(path, version):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/version={version}/run-*/bucket=*/*.parquet"))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_versions_equal_a_merge_of_everything(spark, tmp_path):
    path = str(tmp_path / "dim")
    first = [row(i, "a", D[0]) for i in range(200)] + [row(None, "n", D[0])]
    days = [[row(3, "b", D[1]), row(777, "new", D[1]), row(None, "n2", D[1])], [], [row(i, "c", D[3]) for i in range(150, 260)]]
    got = load(spark, path, first, D[0])
    whole = frame(spark, first)
    assert rows_of(got) == rows_of(whole)
    for day, rows in zip(D[1:], days, strict=False):
        got = load(spark, path, rows, day)
        whole = scd1_merge(whole, frame(spark, rows), **ARGS)
        assert rows_of(got) == rows_of(whole)
        assert rows_of(tables.read_latest_version(spark, path, got.schema)) == rows_of(whole)
    assert tables.stored_versions(spark, path) == [20240101, 20240102, 20240103, 20240104]


def test_bytes_written_follow_the_day(spark, tmp_path):
    path = str(tmp_path / "dim")
    load(spark, path, [row(i, "t" * 50 + str(i), D[0]) for i in range(20_000)], D[0], buckets=32)
    load(spark, path, [row(5, "new", D[1])], D[1], buckets=32)
    assert data_bytes(path, 20240102) < data_bytes(path, 20240101) / 16
    a, b = (tables.version_buckets(spark, path, v) for v in (20240101, 20240102))
    assert len(a.folders) == 32 and sum(a.folders[k] != b.folders[k] for k in a.folders) == 1


def test_other_buckets_are_not_read(spark, tmp_path):
    path = str(tmp_path / "dim")
    load(spark, path, [row(i, "a", D[0]) for i in range(100)], D[0])
    listed = tables.version_buckets(spark, path, 20240101)
    mine = frame(spark, [row(5, "b", D[1])]).select(tables.bucket_of(["id"], 8)).first()[0]
    for k, folder in listed.folders.items():
        if k != mine:
            for f in glob.glob(f"{path}/{folder}/*.parquet"):
                with open(f, "wb") as out:
                    out.write(b"no parquet")
                crc = os.path.join(os.path.dirname(f), "." + os.path.basename(f) + ".crc")
                if os.path.exists(crc):
                    os.remove(crc)
    load(spark, path, [row(5, "b", D[1])], D[1])
    listed = tables.version_buckets(spark, path, 20240102)
    rows = spark.read.parquet(f"{path}/{listed.folders[mine]}").filter("id = '5'").collect()
    assert [(r.title, r.kept) for r in rows] == [("b", "kept-a")]


def test_a_list_cut_short_is_no_version(spark, tmp_path):
    path = str(tmp_path / "dim")
    load(spark, path, [row(1, "a", D[0])], D[0])
    load(spark, path, [row(1, "b", D[1])], D[1])
    name = glob.glob(f"{path}/version=20240102/_buckets-*")[0]
    text = open(name).read()
    for f in glob.glob(f"{path}/version=20240102/._buckets-*.crc"):
        os.remove(f)
    with open(name, "w") as out:
        out.write(text[:-2])
    assert tables.stored_versions(spark, path) == [20240101]
    schema = frame(spark, []).schema
    assert [r.title for r in tables.read_latest_version(spark, path, schema).collect()] == ["a"]
    assert [r.title for r in load(spark, path, [row(1, "c", D[1])], D[1]).collect()] == ["c"]  # run again


def test_rerun_and_whole_versions_of_old(spark, tmp_path):
    path = str(tmp_path / "dim")
    tables.write_version(frame(spark, [row(1, "a", D[0]), row(2, "a", D[0])]), path, 20240101)
    for title in ("b", "c"):
        got = load(spark, path, [row(1, title, D[1])], D[1])
        assert rows_of(got) == [("1", title, "kept-a", D[1]), ("2", "a", "kept-a", D[0])]


def test_expiry_keeps_named_buckets(spark, tmp_path):
    path = str(tmp_path / "dim")
    load(spark, path, [row(i, "a", D[0]) for i in range(100)], D[0])
    for n, day in enumerate(D[1:4]):
        load(spark, path, [row(n, "b", day)], day)
    want = rows_of(tables.read_latest_version(spark, path, frame(spark, []).schema))
    assert tables.expire_versions(spark, path, keep=1) == [20240101, 20240102, 20240103]
    assert tables.stored_versions(spark, path) == [20240104]
    assert rows_of(tables.read_latest_version(spark, path, frame(spark, []).schema)) == want
    assert rows_of(load(spark, path, [row(500, "d", D[4])], D[4])) == sorted([*want, ("500", "d", "kept-d", D[4])], key=str)
