"""Metadata CSV scan and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_metadata_csv(spark: SparkSession, path: str, infer: bool = False,
                      schema: T.StructType | None = None) -> DataFrame:
    """Read the metadata CSV (header row).

    Default: every column as text, named by the header -- no inference pass
    over the data, and the six columns are later selected by name and cast
    (``cleaning.project_metadata`` / ``cast_metadata``), so extra or reordered
    columns are harmless and a bad value never changes a column's type.
    ``infer=True`` is the reference's ``inferSchema`` read (one extra full pass);
    ``schema`` reads positionally with a known layout.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    if infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def write_metadata_csv(df: DataFrame, path: str) -> None:
    """Write a metadata table as CSV with a header (nulls as empty fields)."""
    df.write.mode("overwrite").option("header", True).csv(path)
