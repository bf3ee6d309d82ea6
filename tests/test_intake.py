"""Landed files are taken in once, also after a job that failed."""

import os

import pytest
from pyspark.sql import functions as F

from snapmart.sources import intake, read_table
from snapmart.sources.tables import RUN

SCHEMA = "id string"


class Place:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.landing, self.table, self.ledger = (f"{self.root}/{d}" for d in ("landing", "table", "ledger"))
        os.makedirs(self.landing)

    def drop(self, name, *ids):
        with open(f"{self.landing}/{name}.csv", "w") as out:
            out.write("\n".join(ids) + "\n")

    def rows(self, paths):
        return self.spark.read.schema(SCHEMA).csv(paths) if paths else self.spark.createDataFrame([], SCHEMA)

    def take(self, day, rows=None):
        paths = intake.take_day(self.spark, [self.landing], self.table, self.ledger, "day", day, rows or self.rows)
        return [os.path.basename(p) for p in paths]

    def read(self):
        from pyspark.sql import types as T
        return sorted(tuple(r) for r in read_table(self.spark, self.table, T.StructType.fromDDL(SCHEMA + ", day string")).collect())


def test_a_file_offered_twice_counts_once(spark, tmp_path):
    at = Place(spark, tmp_path)
    at.drop("a", "1", "2")
    at.drop("_half", "9")
    assert at.take("20240101") == ["a.csv"]
    at.drop("b", "3")
    assert at.take("20240102") == ["b.csv"]
    assert at.take("20240103") == []
    assert at.read() == [("1", "20240101"), ("2", "20240101"), ("3", "20240102")]
    at.drop("c", "4")
    assert at.take("20240102") == ["b.csv", "c.csv"]  # a rerun has its own files again
    assert at.take("20240102") == ["b.csv", "c.csv"]
    assert at.read() == [("1", "20240101"), ("2", "20240101"), ("3", "20240102"), ("4", "20240102")]
    assert intake.changed(spark, [at.landing], at.table, at.ledger).isEmpty()
    at.drop("a", "1", "2", "5")  # replaced under its old name
    assert at.take("20240104") == []
    assert [r.day for r in intake.changed(spark, [at.landing], at.table, at.ledger).collect()] == ["20240101"]


def failing(at):
    def rows(paths):
        return at.rows(paths).withColumn("id", F.when(F.col("id") == "2", F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    return rows


def test_a_failed_job_leaves_its_files_to_be_offered_again(spark, tmp_path):
    at = Place(spark, tmp_path)
    at.drop("a", "1", "2")
    with pytest.raises(Exception, match="lost"):
        at.take("20240101", failing(at))
    assert any(f.startswith(RUN) for f in os.listdir(f"{at.ledger}/day=20240101"))  # written, but of no run that counts
    assert intake.taken(spark, at.table, at.ledger).isEmpty()
    assert at.take("20240102") == ["a.csv"]
    at.drop("b", "2")
    with pytest.raises(Exception, match="lost"):  # a rerun that fails keeps the day and its files
        at.take("20240102", failing(at))
    assert at.read() == [("1", "20240102"), ("2", "20240102")]
    assert at.take("20240103") == ["b.csv"]
    assert at.read() == [("1", "20240102"), ("2", "20240102"), ("2", "20240103")]
