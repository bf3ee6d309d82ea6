"""Rows that every operator must take: nulls, empty and long texts, repeated rows, clashing column names."""

import duckdb

CLASH = ("score", "ids", "row", "n", "label", "key", "spans", "length", "hash", "rank", "kept", "found", "text_hash", "part")
LONG = "lorem ipsum dolor " * 4000 + "x" * 9000


def edge_docs(spark, more=()):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, None, "en", None, None), (3, LONG, "en", "a", len(LONG)),
            (4, "one two", "en", "a", 7), (4, "one two", "en", "a", 7), (5, "Ünï çødé 漢字 \t\n x", "fr", "b", None), *more]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *(f"'c' AS {c}" for c in CLASH))


def no_docs(spark):
    return edge_docs(spark).limit(0)


def texts_of(sf):
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
