"""Drift of stored records: the keys that they hold, against the declared schema.

Records are read as VARIANT, so that a key no schema declares is seen too. They
are counted by shape (``schema_of_variant``) first, in one partial aggregation
that keeps one record of each shape. Only these are opened, level by level as
deep as the schema declares structs, so the work after the scan follows the number of
shapes. Counts cover every record.

Cases: a null text, a text cut short, one with a key twice in an object, and one that is no
object are not readable: they count as missing under the path of the record itself
(``""``). A key with value null is present. What lies below an unknown key, or
in an array, is not opened. No records: every declared key is absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.session import scratch_path

# Keys that the extractor does without; all others it requires.
CHANNEL_OPTIONAL = ("id", "snippet.defaultLanguage", "snippet.country")
VIDEO_OPTIONAL = ("id", "snippet.tags", "snippet.localized.defaultAudioLanguage", "topicDetails",
                  "statistics.dislikeCount", "statistics.commentCount")

OBJECT, ARRAY, SCALAR, NULL = "object", "array", "scalar", "null"


def merged_schema(df: DataFrame, json_col: str = "value") -> DataFrame:
    """One row: the schema that all readable records share, as text."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(json_col)).alias("schema"))


def shapes(df: DataFrame, json_col: str = "value") -> DataFrame:
    """One row per shape of record: shape (null: not readable), n, and one record."""
    return df.groupBy(F.schema_of_variant(F.try_parse_json(json_col)).alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), F.min(json_col).alias("record"))


def declared(schema: T.StructType, optional: tuple[str, ...], parent: str = "") -> list[tuple[str, str, str, bool]]:
    """(parent, key, kind, required) of every key of a schema."""
    rows = []
    for f in schema.fields:
        path = f"{parent}.{f.name}" if parent else f.name
        kind = {T.StructType: OBJECT, T.ArrayType: ARRAY}.get(type(f.dataType), SCALAR)
        rows.append((parent, f.name, kind, path not in optional))
        if kind == OBJECT:
            rows += declared(f.dataType, optional, path)
    return rows


def _kind(v: Column) -> Column:
    shape = F.schema_of_variant(v)
    return (F.when(shape.startswith("OBJECT<"), OBJECT).when(shape.startswith("ARRAY<"), ARRAY)
            .when(shape == "VOID", NULL).otherwise(SCALAR))


def _path(parent: str, key: str) -> Column:
    return F.when(F.col(parent) == "", F.col(key)).otherwise(F.concat_ws(".", parent, key))


def drift(df: DataFrame, schema: T.StructType, optional: tuple[str, ...] = (), json_col: str = "value") -> DataFrame:
    """One row per key, declared or met: path, declared, required, n_parents
    (objects that should hold it), n_present, n_null, n_missing, n_retyped (neither
    null nor of the declared kind), status.

    status: ``unknown`` (not declared), ``missing`` (required, and some parent lacks
    it), ``retyped``, ``absent`` (optional, never met), ``ok``; the first that holds."""
    spark = df.sparkSession
    path = scratch_path(spark, "record_shapes")
    shapes(df, json_col).write.parquet(path)  # small, and opened once a level
    stored = spark.read.schema("shape string, n bigint, record string").parquet(path)

    keys = declared(schema, optional)
    v = F.try_parse_json("record")
    record = F.col("shape").isNotNull() & (_kind(v) == OBJECT)
    at = stored.filter(record).select(F.lit("").alias("at"), v.alias("v"), "n")
    levels = []
    for depth in range(1 + max((p.count(".") + 1 for p, *_ in keys if p), default=0)):
        below = at.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(
            F.col("at").alias("parent"), "key", F.col("value").alias("v"), "n")
        levels.append(below.select("parent", "key", _kind(F.col("v")).alias("kind"), "n"))
        open_ = [p for p in {p for p, *_ in keys} if p and p.count(".") == depth]
        at = below.withColumn("at", _path("parent", "key")).filter(
            F.col("at").isin(open_) & ~F.contains("key", F.lit(".")) & (_kind(F.col("v")) == OBJECT)).select("at", "v", "n")
    met = levels[0]
    for level in levels[1:]:
        met = met.unionAll(level)
    whole = stored.select(F.lit(None).cast("string").alias("parent"), F.lit("").alias("key"),
                          F.when(record, OBJECT).alias("kind"), "n")
    of = lambda *kinds: F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds), F.col("n"))), F.lit(0))
    found = met.unionAll(whole).groupBy("parent", "key").agg(
        F.sum("n").alias("n_all"), *(of(k).alias(k) for k in (OBJECT, ARRAY, SCALAR, NULL)))

    want = spark.createDataFrame([(None, "", OBJECT, True), *keys], "parent string, key string, want string, required boolean")
    both = found.join(want, found["parent"].eqNullSafe(want["parent"]) & (found["key"] == want["key"]), "full")
    both = both.select(F.coalesce(found["parent"], want["parent"]).alias("parent"), F.coalesce(found["key"], want["key"]).alias("key"),
                       "want", "required", "n_all", OBJECT, ARRAY, SCALAR, NULL)
    owner = found.select(F.when(F.col("parent").isNull(), "").otherwise(_path("parent", "key")).alias("owner"), F.col(OBJECT).alias("owners"))
    # an unknown key may spell the path of a nested one; only declared parents own keys
    owner = owner.groupBy("owner").agg(F.max("owners").alias("owners"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    present = F.when(F.col("parent").isNull(), zero(OBJECT)).otherwise(zero("n_all"))
    told = both.join(owner, both["parent"] == owner["owner"], "left").select(
        F.when(F.col("parent").isNull(), "").otherwise(_path("parent", "key")).alias("path"),
        F.col("want").isNotNull().alias("declared"), F.coalesce("required", F.lit(False)).alias("required"),
        F.when(F.col("parent").isNull(), zero("n_all")).otherwise(zero("owners")).alias("n_parents"),
        present.alias("n_present"), zero(NULL).alias("n_null"), "want", OBJECT, ARRAY, SCALAR)
    right = F.when(F.col("want") == OBJECT, zero(OBJECT)).when(F.col("want") == ARRAY, zero(ARRAY)).otherwise(zero(SCALAR))
    other = F.when(F.col("declared"), F.col("n_present") - F.col("n_null") - right).otherwise(F.lit(0))
    told = told.withColumns({"n_missing": F.col("n_parents") - F.col("n_present"), "n_retyped": other.cast("bigint")})
    status = (F.when(~F.col("declared"), "unknown").when(F.col("required") & (F.col("n_missing") > 0), "missing")
              .when(F.col("n_retyped") > 0, "retyped").when(F.col("n_present") == 0, "absent").otherwise("ok"))
    return told.select("path", "declared", "required", "n_parents", "n_present", "n_null", "n_missing", "n_retyped", status.alias("status"))
