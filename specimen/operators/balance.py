"""Class balance: how many images each class lacks, and which image gets
which variant to fill the gap (the reference's task 4, planned not generated
by a model), plus the optional binary relabelling (task 3.1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specimen.functions.scalar import binary_label, null_label
from specimen.operators.ordinal import with_ordinal
from specimen.schema import VARIANTS

N_VARIANTS = len(VARIANTS)


def class_deficit(df: DataFrame, column: str = "dx") -> DataFrame:
    """(value, n, majority_n, deficit, n_images, unfilled) per class.

    ``deficit`` = majority count - count.  At most 9 variants per image exist,
    so ``unfilled`` = what stays missing after every variant is used.
    """
    per = df.groupBy(null_label(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("image_id").alias("n_images"))
    # the majority count is merged from per-partition maxima of the class table
    per = with_ordinal(per, [F.desc("n"), F.asc("value")], name="_r",
                       totals={"majority_n": ("n", "max")})
    majority = F.col("majority_n")
    return per.select(
        "value", "n", "majority_n", (majority - F.col("n")).alias("deficit"), "n_images",
        F.greatest(majority - F.col("n") - F.col("n_images") * N_VARIANTS, F.lit(0))
        .alias("unfilled"))


def balance_plan(df: DataFrame, column: str = "dx") -> DataFrame:
    """(value, image_id, variant, plan_rank): the variants to generate.

    The order inside a class is (variant order, image_id): every image gets
    variant 1 first, then variant 2, ...; rows are taken while the rank is at
    most the class deficit.  Instead of ranking image x variant pairs in one
    window per class, each image's position r among the n_c images of its
    class is computed in parallel (``with_ordinal``); image r then takes
    variants 1..k with k = min(9, floor((deficit - r) / n_c) + 1), and
    plan_rank = (variant_rank - 1) * n_c + r.
    """
    per_image = df.groupBy(null_label(column).alias("value"), "image_id").agg(F.count(F.lit(1)).alias("n"))
    ranked = with_ordinal(per_image.filter(F.col("image_id").isNotNull()), ["image_id"], group_by=["value"],
                          name="r", count_name="n_c")
    # class totals: one row per class, and the largest of them as one number
    sizes = per_image.groupBy("value").agg(F.sum("n").alias("n_class"))
    most = sizes.select(F.max("n_class")).scalar()
    deficits = sizes.select("value", (most - F.col("n_class")).alias("deficit")).filter(F.col("deficit") > 0)
    ranked = ranked.join(deficits, on="value")
    k = F.least(F.lit(N_VARIANTS),
                F.floor((F.col("deficit") - F.col("r")) / F.col("n_c")).cast("int") + 1)
    suffixes = F.array(*[F.lit(v[1]) for v in VARIANTS])
    fan = ranked.filter(F.col("r") <= F.col("deficit")).select(
        "value", "image_id", "r", "n_c", F.explode(F.sequence(F.lit(1), k)).alias("variant_rank"))
    return fan.select(
        "value", "image_id", F.element_at(suffixes, F.col("variant_rank")).alias("variant"),
        "variant_rank",
        ((F.col("variant_rank") - 1) * F.col("n_c") + F.col("r")).cast("long").alias("plan_rank"))


def binary_label_counts(df: DataFrame, column: str = "dx",
                        malignant: list[str] | None = None) -> DataFrame:
    """(label, n): rows per binary label."""
    return (df.groupBy(null_label(binary_label(column, malignant)).alias("label"))
            .agg(F.count(F.lit(1)).alias("n")))
