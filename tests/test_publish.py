"""Days are published after their job has committed: a failed job changes nothing a reader sees."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from snapmart import schemas
from snapmart.operators import facts, reports
from snapmart.sources import tables

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def rows(spark, day, n):
    return spark.range(0, n, 1, 4).select(F.col("id").cast("string").alias("k"), F.col("id").alias("n"), F.lit(day).alias("updated_date"))


def failing(df, column):
    """Most tasks write their rows, then one fails."""
    return df.withColumn(column, F.when(F.col("n") == 90, F.raise_error(F.lit("lost half-way")).cast("long")).otherwise(F.col("n")))



@pytest.mark.parametrize("rerun", [False, True])
def test_failed_curated_write_leaves_the_day(spark, tmp_path, rerun):
    path = str(tmp_path / "curated")
    df = rows(spark, D1, 10)
    tables.write_day(df, path, "updated_date", D1)
    day = D1 if rerun else D2
    with pytest.raises(Exception, match="lost half-way"):
        tables.write_day(failing(rows(spark, day, 100), "n"), path, "updated_date", day)
    assert tables.read_day(spark, path, df.schema, D1).count() == 10
    assert tables.read_day(spark, path, df.schema, D2).count() == 0
    assert tables.read_table(spark, path, df.schema).count() == 10
    tables.write_day(rows(spark, day, 100), path, "updated_date", day)
    assert tables.read_day(spark, path, df.schema, day).count() == 100
    assert tables.read_table(spark, path, df.schema).count() == (100 if rerun else 110)


def test_failed_first_write_of_a_table_is_no_table_yet(spark, tmp_path):
    path = str(tmp_path / "curated")
    with pytest.raises(Exception, match="lost half-way"):
        tables.write_day(failing(rows(spark, D1, 100), "n"), path, "updated_date", D1)
    schema = rows(spark, D1, 1).schema
    assert tables.read_table(spark, path, schema).count() == 0
    assert tables.read_day(spark, path, schema, D1).count() == 0


def fact(spark, day, n):
    df = rows(spark, day, n)
    return df.select(F.col("k").alias("channel_id"), *(F.col("n").alias(c) for c in ("views_count", "subscribers_count", "videos_count")),
                     F.lit(day.strftime("%Y%m%d")).alias("snapshot_date"))


@pytest.mark.parametrize("rerun", [False, True])
def test_failed_fact_write_leaves_the_newest_snapshot(spark, tmp_path, rerun):
    path = str(tmp_path / "fact")
    facts.write_snapshot_day(fact(spark, D1, 5), path, D1)
    day = D1 if rerun else D2
    bad = fact(spark, day, 100).withColumn("views_count", F.when(F.col("views_count") == 90, F.raise_error(F.lit("lost half-way")).cast("long"))
                                           .otherwise(F.col("views_count")))
    with pytest.raises(Exception, match="lost half-way"):
        facts.write_snapshot_day(bad, path, day)
    newest = facts.read_latest_snapshot(spark, path, schemas.CHANNEL_FACT)
    assert newest.count() == 5
    assert {r.snapshot_date for r in newest.collect()} == {"20240101"}
    assert facts.read_snapshots(spark, path, schemas.CHANNEL_FACT).count() == 5


def test_driver_lost_before_the_marker(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    facts.write_snapshot_day(fact(spark, D1, 5), path, D1)
    monkeypatch.setattr(tables, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    for day in (D1, D2):
        with pytest.raises(KeyboardInterrupt):
            facts.write_snapshot_day(fact(spark, day, 9), path, day)
    assert facts.read_latest_snapshot(spark, path, schemas.CHANNEL_FACT).count() == 5
    assert facts.read_snapshots(spark, path, schemas.CHANNEL_FACT).count() == 5


def test_newest_day_without_rows_is_passed_over_as_the_maximum_does(spark, tmp_path):
    path = str(tmp_path / "fact")
    with pytest.raises(FileNotFoundError):
        facts.read_latest_snapshot(spark, path, schemas.CHANNEL_FACT)
    facts.write_snapshot_day(fact(spark, D1, 5), path, D1)
    facts.write_snapshot_day(fact(spark, D2, 4), path, D2)
    facts.write_snapshot_day(fact(spark, D2, 0), path, D2)
    newest = facts.read_latest_snapshot(spark, path, schemas.CHANNEL_FACT)
    by_rows = reports.latest(facts.read_snapshots(spark, path, schemas.CHANNEL_FACT))
    assert sorted(map(tuple, newest.collect())) == sorted(map(tuple, by_rows.collect()))
    assert newest.count() == 5
    facts.write_snapshot_day(fact(spark, D1, 0), path, D1)
    assert facts.read_latest_snapshot(spark, path, schemas.CHANNEL_FACT).count() == 0


def test_runs_beside_a_backfill_and_expiry(spark, tmp_path):
    path = str(tmp_path / "curated")
    both = rows(spark, D1, 3).union(rows(spark, D2, 4))
    tables.write_days(both, path, "updated_date")
    assert tables.current_folders(spark, path) is None
    tables.write_day(rows(spark, D2, 7), path, "updated_date", D2)
    old = tables.read_day(spark, path, both.schema, D2)  # a reader that holds this run
    tables.write_day(rows(spark, D2, 8), path, "updated_date", D2)
    assert old.count() == 7
    assert sorted((r.updated_date, r["count"]) for r in tables.read_table(spark, path, both.schema).groupBy("updated_date").count().collect()) == [
        (D1, 3), (D2, 8)]
    assert tables.read_day(spark, path, both.schema, D1).count() == 3
    assert len([n for n in tables.expire_runs(spark, path, "updated_date", D2) if n.startswith("run-")]) == 1
    assert tables.expire_runs(spark, path, "updated_date", D1) == []
    assert tables.read_table(spark, path, both.schema).count() == 11
    tables.write_days(rows(spark, D2, 2), path, "updated_date")  # a backfill replaces the day's folder, runs and all
    assert tables.read_day(spark, path, both.schema, D2).count() == 2
    assert not [n for n in os.listdir(f"{path}/updated_date={D2}") if n.startswith("run-")]
    assert tables.read_day(spark, path, both.schema, D3).count() == 0
