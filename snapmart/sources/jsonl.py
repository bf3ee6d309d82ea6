"""Stored listing-service responses: JSON-lines files, one record or one
response page per line. Read as text so the flatteners parse each line with
the declared schema; every file of a folder (all pages of all channels) is
one scan, split across tasks like any line-based file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_json_lines(spark: SparkSession, path) -> DataFrame:
    """One row per line, in column ``value``."""
    return spark.read.text(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a single string column named ``value`` as JSON-lines text."""
    df.select("value").write.mode(mode).text(path)
