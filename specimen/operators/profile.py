"""Profiling aggregates: counts, nulls, distinct values, class frequencies,
numeric summary, schema and column profile.

The reference launches one Spark job per metric and column (32 actions per
run).  Here each report is one scan: all columns are aggregated together
(``count_if`` per column) or unpivoted into (column, value) pairs and grouped
once -- Expand, partial aggregate, one shuffle, final aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specimen.functions.scalar import format_percent, null_label, percent_of_total, upper_title
from specimen.operators.ordinal import with_ordinal
from specimen.schema import REPORT_COLUMNS, SHOW_ROWS

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def row_count(df: DataFrame) -> DataFrame:
    """(n_rows) (A1)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(position, column_name, null_count) for every column, one scan (A3)."""
    cols = columns or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    stacked = wide.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"),
                 F.col(f"c{i}").alias("null_count")) for i, c in enumerate(cols)])).alias("s"))
    return stacked.select("s.*")


def null_count_column(df: DataFrame, column: str) -> DataFrame:
    """(column_name, null_count) of one column (A4)."""
    return df.agg(F.lit(column).alias("column_name"),
                  F.count_if(F.col(column).isNull()).alias("null_count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of a column, as text (A5)."""
    return (df.select(F.col(column).cast("string").alias("value"))
            .filter(F.col("value").isNotNull()).distinct())


def class_frequency(df: DataFrame, column: str) -> DataFrame:
    """(value, n, percent, percent_text, rank) of one column.

    Nulls are a class shown as 'NULL' and count in the denominator (M10);
    rank orders by count descending, ties by value.
    """
    counts = df.groupBy(null_label(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = with_ordinal(counts, [F.desc("n"), F.asc("value")], name="rank",
                          totals={"_total": ("n", "sum")})
    return ranked.select("value", "n", percent_of_total("n", "_total").alias("percent"),
                         format_percent("n", "_total").alias("percent_text"), "rank")


def frequency_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Class frequencies of several columns in one scan.

    (column_name, title, value, n, percent, percent_text, rank) -- unpivot to
    (column, value), one grouped aggregate, rank within each column.
    """
    cols = columns or REPORT_COLUMNS
    pairs = df.select(*[null_label(c).alias(c) for c in cols]).unpivot([], cols, "column_name", "value")
    counts = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    # every column has one value per row (nulls are a class): the column's sum
    # of counts is the row count
    ranked = with_ordinal(counts, [F.desc("n"), F.asc("value")], group_by=["column_name"],
                          name="rank", totals={"_total": ("n", "sum")})
    return ranked.select("column_name", upper_title("column_name").alias("title"), "value", "n",
                         percent_of_total("n", "_total").alias("percent"),
                         format_percent("n", "_total").alias("percent_text"), "rank")


def column_stats(df: DataFrame, columns: list[str] | None = None,
                 approx_distinct: bool = False, rsd: float = 0.01) -> DataFrame:
    """Per column: total rows, nulls and number of distinct non-null values --
    the header of each block of the reference's report (A4, A5), one scan.

    The exact form groups by (column, value) first; for very wide columns
    (an id column) ``approx_distinct=True`` uses ``approx_count_distinct``
    (HyperLogLog++, relative error ``rsd``), whose state per column is a
    fixed-size sketch instead of one row per distinct value.
    """
    cols = columns or REPORT_COLUMNS
    pairs = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column_name", "value")
    if approx_distinct:
        return pairs.groupBy("column_name").agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col("value").isNull()).alias("null_count"),
            F.approx_count_distinct("value", rsd).alias("n_distinct"))
    per_value = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("total_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.count_if(F.col("value").isNotNull()).alias("n_distinct"))


def describe_numeric(df: DataFrame, column: str = "age") -> DataFrame:
    """count, mean, stddev, min, max of a numeric column.

    ``describe()`` returns strings; typed aggregates are kept instead, mean
    and stddev rounded to 6 digits for comparison across engines.
    """
    c = F.col(column).cast("double")
    return df.agg(
        F.count(c).alias("count"),
        F.round(F.avg(c), 6).alias("mean"),
        F.round(F.stddev_samp(c), 6).alias("stddev"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    )


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable, non_null).

    Names and types come from the schema; the non-null count reads the data
    in the same single scan.
    """
    fields = df.schema.fields
    wide = df.agg(*[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.lit(f.nullable).alias("nullable"), F.col(f"c{i}").alias("non_null"))
        for i, f in enumerate(fields)])).alias("s")).select("s.*")


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, nulls and -- for numeric columns -- count,
    mean, stddev, min, max (A15).  All metrics in one aggregate, then stacked."""
    fields = df.schema.fields
    aggs = []
    for i, f in enumerate(fields):
        c = F.col(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"n{i}"))
        if isinstance(f.dataType, _NUMERIC):
            d = c.cast("double")
            aggs += [F.count(d).alias(f"k{i}"), F.round(F.avg(d), 6).alias(f"m{i}"),
                     F.round(F.stddev_samp(d), 6).alias(f"s{i}"), F.min(d).alias(f"lo{i}"),
                     F.max(d).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    none_l, none_d = F.lit(None).cast("long"), F.lit(None).cast("double")
    rows = []
    for i, f in enumerate(fields):
        num = isinstance(f.dataType, _NUMERIC)
        rows.append(F.struct(
            F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"n{i}").alias("null_count"),
            (F.col(f"k{i}") if num else none_l).alias("count"),
            (F.col(f"m{i}") if num else none_d).alias("mean"),
            (F.col(f"s{i}") if num else none_d).alias("stddev"),
            (F.col(f"lo{i}") if num else none_d).alias("min"),
            (F.col(f"hi{i}") if num else none_d).alias("max")))
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def head_rows(df: DataFrame, order: list, n: int = SHOW_ROWS) -> DataFrame:
    """The first ``n`` rows in a given order, as ``show()`` displays them (O2)."""
    return df.orderBy(*order).limit(n)


def dataset_overview(originals: DataFrame, unlabelled: DataFrame, meta: DataFrame,
                     target: str = "dx") -> DataFrame:
    """(metric, value, n): number of images, images without label, and one row per
    target label with its rows (A14).  The labels are a table, never one row."""
    def ids(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.countDistinct("image_id").alias("n")).select(
            F.lit(name).alias("metric"), F.lit(None).cast("string").alias("value"), "n")
    labels = (meta.filter(F.col(target).isNotNull()).groupBy(F.col(target).cast("string").alias("value"))
              .agg(F.count(F.lit(1)).alias("n")).select(F.lit("label").alias("metric"), "value", "n"))
    return ids(originals, "images").unionByName(ids(unlabelled, "without_label")).unionByName(labels)
