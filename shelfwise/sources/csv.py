"""CSV source and sink with an explicit schema (A1).

Every field of the reference's files is a string and names may hold commas
and quotes.  Reads pass a declared schema (never ``inferSchema``), keep
malformed rows in a corrupt-record column instead of failing (PERMISSIVE),
and use the same quote and escape character on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "false"}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """Read with ``schema``; if it has a ``_corrupt`` string field, short and
    long rows keep their text there.  ``multiline``: quoted fields may hold line breaks;
    a file is then not split, so keep such files small.

    The reader parses only the columns a query uses, and malformed-line
    detection follows that set: use every column when ``_corrupt`` matters
    (the CSV loader writes all of them to a staging table first)."""
    reader = (spark.read.schema(schema).options(**CSV_OPTIONS).option("mode", "PERMISSIVE")
              .option("multiLine", multiline))
    if CORRUPT in schema.fieldNames():
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path)


def header_schema(spark: SparkSession, path: str, columns: Sequence[str],
                  multiline: bool = False) -> T.StructType:
    """All-string schema in the order of the header that the files have.

    The header must name exactly ``columns``, in any order; anything else is an
    error.  Reading with it checks every file's own header against it, so a
    folder of files with different orders fails instead of mixing columns up."""
    found = spark.read.options(**CSV_OPTIONS).option("multiLine", multiline).csv(path).columns
    if sorted(found) != sorted(columns):
        raise ValueError(f"header of {path} is {found}, expected {list(columns)} in any order")
    return T.StructType([T.StructField(c, T.StringType()) for c in [*found, CORRUPT]])


def good_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
