"""Projection, casts, sampling, filters and the quarantine of unusable rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specimen.schema import METADATA_COLUMNS, SAMPLE_SEED


def project_metadata(raw: DataFrame) -> DataFrame:
    """Keep the six metadata columns (P1); unused columns leave the scan."""
    return raw.select(*METADATA_COLUMNS)


def cast_metadata(df: DataFrame) -> DataFrame:
    """``image_id`` as string (P2) and ``age`` as double.

    ``try_cast`` turns an unparseable age into null instead of failing the job
    under ANSI mode (M3); such rows are then quarantined like a missing age.
    """
    return (df.withColumn("image_id", F.col("image_id").cast("string"))
            .withColumn("age", F.col("age").try_cast("double")))


def sample_fraction(df: DataFrame, fraction: float, key: str = "image_id",
                    seed: int = SAMPLE_SEED, mode: str = "hash") -> DataFrame:
    """Sample a fraction of rows.

    Only ``0 < fraction < 1`` samples; anything else keeps all rows (M1).
    ``mode='hash'`` keeps a row when a hash of its key falls below the fraction,
    so the kept set is the same at any partitioning and in any engine, and all
    rows of one key are kept or dropped together (M2).  ``mode='bernoulli'`` is
    Spark's ``sample(False, f, seed)`` as in the reference.
    """
    if not (0 < fraction < 1):
        return df
    if mode == "bernoulli":
        return df.sample(False, fraction, seed=seed)
    return df.filter(key_hash(df, key) < fraction * 2.0 ** 32)


def key_hash(df: DataFrame, key: str) -> F.Column:
    """The first 32 bits of md5(key); rows without a key hash their other
    columns instead, so they are sampled one by one and not all together."""
    others = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns if c != key]
    h = F.md5(F.coalesce(F.col(key).cast("string"), F.concat_ws("|", F.lit(""), *others)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def filter_age_present(df: DataFrame) -> DataFrame:
    return df.filter(F.col("age").isNotNull())          # F1


def filter_has_image(df: DataFrame) -> DataFrame:
    return df.filter(F.col("img_path").isNotNull())     # F2


def filter_age_missing(df: DataFrame) -> DataFrame:
    return df.filter(F.col("age").isNull())             # F3


def filter_null_any(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())            # F4


def filter_path_exists(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """Rows whose ``img_path`` is a listed file (F6), as a semi join."""
    files = listing.select(F.col("path").alias("img_path"))
    return rows.join(files, on="img_path", how="left_semi")


def spread_join(rows: DataFrame, unique: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``unique`` (one row per ``key``) so that a hot key can be split.

    Adaptive execution splits a skewed join only between two exchanges, but an
    aggregate already partitioned by the key would be joined where it lies.
    Joining on the key and a function of it asks both sides for an exchange;
    for ``unique`` that is one of small rows, for ``rows`` the one it needs anyway.
    """
    deal = F.crc32(F.col(key).cast("string"))
    return rows.withColumn("_deal", deal).join(unique.withColumn("_deal", deal), [key, "_deal"], how).drop("_deal")


def enrich(raw: DataFrame, resolved: DataFrame, keep_age_text: bool = False) -> DataFrame:
    """Project, cast and attach the image path: the table before cleaning.
    ``keep_age_text`` adds the age as it was written."""
    rows = project_metadata(raw).withColumn("age_text", F.col("age").cast("string"))
    more = ["age_text"] if keep_age_text else []
    return spread_join(cast_metadata(rows), resolved, "image_id", "left").select(
        *METADATA_COLUMNS, "img_path", *more)


def quarantine_null_age(enriched: DataFrame) -> DataFrame:
    """Rows with a missing age and the image they point at.

    The reference deletes those files; here they are listed instead and every
    consumer anti-joins them, so no input is ever changed.
    """
    return (enriched.filter(F.col("age").isNull())
            .select("image_id", "img_path", F.lit("null_age").alias("reason")))


def _quarantined_ids(enriched: DataFrame) -> DataFrame:
    # the reference deletes only files it found; later rows with the same id
    # then resolve to nothing (M6).  distinct() pre-aggregates map-side, so a
    # hot id becomes one row before the shuffle.
    return enriched.filter(F.col("age").isNull() & F.col("img_path").isNotNull()).select("image_id").distinct()


def clean_and_enrich(raw: DataFrame, resolved: DataFrame) -> DataFrame:
    """Rows kept by cleaning (F8): age present, image found, and the image not
    quarantined (M6).

    The quarantine is decided on one row per id before the rows see it: ids
    with a missing age (a partial aggregate, so a hot id is one row per task)
    leave the resolved catalog, and the rows meet what is left in one join
    that adaptive execution can split.
    """
    rows = cast_metadata(project_metadata(raw))
    no_age = rows.groupBy("image_id").agg(F.bool_or(F.col("age").isNull()).alias("_q"))
    usable = (resolved.join(no_age.filter("_q").select("image_id"), "image_id", "left_anti"))
    kept = spread_join(rows.filter(F.col("age").isNotNull()), usable, "image_id")
    return kept.select(*METADATA_COLUMNS, "img_path")


def keep_clean(enriched: DataFrame) -> DataFrame:
    """The cleaning rule applied to an already enriched table (F8)."""
    kept = enriched.filter(F.col("age").isNotNull() & F.col("img_path").isNotNull())
    return spread_join(kept, _quarantined_ids(enriched), "image_id", "left_anti") \
        .select(*METADATA_COLUMNS, "img_path")


def anti_quarantine(enriched: DataFrame) -> DataFrame:
    """Rows whose image id is not quarantined."""
    return spread_join(enriched, _quarantined_ids(enriched), "image_id", "left_anti").select(*enriched.columns)


def cleaning_delta(enriched: DataFrame) -> DataFrame:
    """Rows before and after cleaning, with the reason of each removal (A2, M7).

    The rows are reduced to one row per id before the quarantine is known: it
    holds for all rows of an id alike, so four counts per id are enough and no
    join sees a hot id.  ``age_cast_failures`` counts ages that were given but
    are no number, where ``enriched`` carries the raw text as ``age_text``;
    they are part of ``removed_null_age``.
    """
    no_age = F.col("age").isNull()
    no_img = F.col("img_path").isNull()
    bad = F.count_if(no_age & F.col("age_text").isNotNull()) if "age_text" in enriched.columns else F.lit(0)
    per_id = enriched.groupBy("image_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(no_age).alias("n_age"),
        F.count_if(~no_age & no_img).alias("n_img"), F.count_if(~no_age & ~no_img).alias("n_good"),
        F.bool_or(no_age & ~no_img & F.col("image_id").isNotNull()).alias("_q"),
        bad.cast("long").alias("n_bad"))
    quarantined = F.when(F.col("_q"), F.col("n_good")).otherwise(0)
    kept = F.when(F.col("_q"), 0).otherwise(F.col("n_good"))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    return per_id.agg(
        total(F.col("n"), "rows_before"), total(kept, "rows_after"),
        total(F.col("n") - kept, "rows_removed"), total(F.col("n_age"), "removed_null_age"),
        total(F.col("n_img"), "removed_no_image"), total(quarantined, "removed_quarantined_id"),
        total(F.col("n_bad"), "age_cast_failures"))


def skip_missing_image(enriched: DataFrame, listing: DataFrame) -> DataFrame:
    """Per row: would preprocessing skip it (null/empty path or file absent)?"""
    files = listing.select(F.col("path").alias("img_path"), F.lit(True).alias("_exists")).distinct()
    return (enriched.join(files, on="img_path", how="left")
            .select("image_id", "img_path",
                    (F.col("img_path").isNull() | (F.col("img_path") == "") |
                     F.col("_exists").isNull()).alias("skipped")))
