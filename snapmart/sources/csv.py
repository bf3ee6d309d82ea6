"""Raw CSV listings: header row, quoted multi-line text, declared schema.

Quotes inside a field are doubled (RFC 4180), so the reader needs
``escape='"'``; without it a field holding a quote and a comma or newline
shifts columns. A multi-line file cannot be split, so parallelism comes
from the number of files: writers keep one file per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_QUOTING = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path, schema: StructType, multiline: bool = True) -> DataFrame:
    return (spark.read.schema(schema)
            .options(header=True, multiLine=multiline, mode="PERMISSIVE", **_QUOTING)
            .csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", bom: bool = False) -> None:
    """Header + rows; text kept byte for byte (no whitespace trimming).
    Null and '' both read back as null (an empty field), as in the
    listing files, where the extractor writes both the same way. ``bom``
    starts every file with a byte-order mark, as spreadsheets expect."""
    if bom:
        df = df.toDF("\ufeff" + df.columns[0], *df.columns[1:])
    (df.write.mode(mode)
       .options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                **_QUOTING)
       .csv(path))
