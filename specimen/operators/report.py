"""Run reports: status tally, success rate, variant verification, augmentation
totals and the final summary -- DataFrames, never printed text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specimen.functions import paths as P
from specimen.schema import STATUS_SKIPPED, STATUS_SUCCESS, VARIANTS


def variant_dimension(spark) -> DataFrame:
    """The nine variants as a 9-row table (fixed size, safe to broadcast)."""
    return spark.createDataFrame(
        [(i + 1, name, suffix) for i, (name, suffix, _) in enumerate(VARIANTS)],
        "variant_rank int, transform string, variant string")


def status_counts(processed: DataFrame) -> DataFrame:
    """(status, category, n): rows per status (A9).  Each distinct failure
    message is not its own group (M13): the message is in ``error``."""
    cat = (F.when(F.col("status") == STATUS_SUCCESS, "success")
           .when(F.col("status") == STATUS_SKIPPED, "skipped").otherwise("failed"))
    return processed.groupBy("status").agg(F.count(F.lit(1)).alias("n")) \
        .select("status", cat.alias("category"), "n")


def success_rate(processed: DataFrame) -> DataFrame:
    """(n_rows, n_success, success_rate) with rate null for no rows."""
    return processed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("status") == STATUS_SUCCESS).alias("n_success"),
    ).select("n_rows", "n_success",
             (F.col("n_success") * 100.0 / F.nullif(F.col("n_rows"), F.lit(0))).alias("success_rate"))


def variant_counts(files: DataFrame, path_col: str = "path") -> DataFrame:
    """(variant, n) per suffix with zero rows kept, plus a 'TOTAL' row.

    ``files`` is a listing (or any table with a path column); the reference
    globs ``*<suffix>.*`` in both folders.
    """
    per = (files.select(P.variant_suffix(path_col).alias("variant"))
           .filter(F.col("variant").isNotNull())
           .groupBy("variant").agg(F.count(F.lit(1)).alias("n")))
    dims = variant_dimension(files.sparkSession)
    full = (F.broadcast(dims).join(per, on="variant", how="left")
            .select("variant_rank", "variant", F.coalesce("n", F.lit(0)).cast("long").alias("n")))
    rolled = full.rollup("variant_rank", "variant").agg(F.sum("n").alias("n"))
    # keep the leaves and the grand total only (rollup also yields the
    # per-rank subtotal, equal to its leaf)
    return rolled.filter(F.col("variant").isNotNull() | F.col("variant_rank").isNull()).select(
        F.coalesce("variant_rank", F.lit(len(VARIANTS) + 1)).alias("variant_rank"),
        F.coalesce("variant", F.lit("TOTAL")).alias("variant"), F.col("n").cast("long").alias("n"))


def augment_totals(augmented: DataFrame) -> DataFrame:
    """(node, originals, variants_ok, variants_failed) per node plus node 0 =
    all nodes (A12), in one pass (``rollup``).  ``augmented`` has one row per
    (row, variant) with ``node`` and ``ok``; like the reference's counters, a
    file listed by two rows counts twice."""
    rolled = augmented.rollup("node").agg(
        F.countDistinct("image_id").alias("originals"),
        F.count_if(F.col("ok")).alias("variants_ok"),
        F.count_if(~F.col("ok")).alias("variants_failed"))
    return rolled.select(F.coalesce("node", F.lit(0)).cast("int").alias("node"),
                         "originals", "variants_ok", "variants_failed")


def run_summary(final: DataFrame, fraction: float) -> DataFrame:
    """(n_rows, columns, sample_fraction) of the final table."""
    return final.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(", ".join(final.columns)).alias("columns"),
        F.lit(float(fraction)).alias("sample_fraction"))
