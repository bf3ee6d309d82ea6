"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.session import scratch_path

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` under the shared work folder and read it back.

    Cuts the lineage at a table that outlives any executor, and pins rows
    whose identity is made on the way (row ids, ranks within a task).
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of shuffle files whose results are stored: Spark drops them when
    the driver's garbage is collected, which a roomy driver seldom does."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def tidy(spark: SparkSession) -> None:
    """Executors collect their garbage and give the heap they no longer need
    back to the system, one task a core. A heap that an earlier step has filled
    otherwise keeps its size beside the Python workers of the next."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.expr("reflect('java.lang.System', 'gc')")).collect()


def texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and whole text, null text as the empty one. Every other
    column is left behind, so no extra column can clash."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def recounted(docs: DataFrame) -> DataFrame:
    """``n_chars``, if there, as the length of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))
