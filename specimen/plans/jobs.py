"""End-to-end jobs: augmentation, preprocessing and the full preparation run.

The reference collects the path list to the driver and loops over it
(augmentation), and runs preprocessing as a row-at-a-time UDF that overwrites
each input file.  Here both are distributed table jobs: the distinct file
paths of the metadata rows select the decoded images (a semi join that AQE
turns into a broadcast when the path list is small), ``mapInArrow`` kernels
process each file once and produce new tables, and per-row results join back
without pixels.  Inputs are never modified, so a retried task cannot process
an image twice (M14).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specimen.operators import balance, catalog as cat
from specimen.operators import cleaning, profile, report
from specimen.functions import paths as P
from specimen.operators.images import (PREPROCESSED, augment_variants, derive_images,
                                      preprocess_images)
from specimen.schema import DEFAULT_SAMPLE_FRACTION, REPORT_COLUMNS, STATUS_SKIPPED
from specimen.sources import images as src_images
from specimen.sources import metadata as src_meta

_PIXELS = ["height", "width", "n_channels", "data"]


def select_images(rows: DataFrame, images: DataFrame) -> DataFrame:
    """Decoded images of the distinct files the rows point at: (img_path, pixels).

    The path list is deduplicated first (a partial aggregate: a path repeated
    by a third of all rows becomes one row before any shuffle), so every
    image is decoded and processed once however many rows refer to it.  The
    semi join lets AQE broadcast the path list when it is small and stream
    the image table without shuffling pixels.
    """
    paths = rows.select("img_path").filter(F.col("img_path").isNotNull()).distinct()
    pix = images.select(F.col("path").alias("img_path"), *_PIXELS)
    return pix.join(paths, on="img_path", how="left_semi")


def decode_selected(rows: DataFrame, decoder, listing: DataFrame | None = None) -> DataFrame:
    """Decoded images of the distinct files the rows point at, read by path on
    the executors with ``decoder`` (see ``sources.images.decode_paths``):
    (img_path, pixels).  Files no row selects are never opened.  ``listing`` (path,
    length) adds the files' sizes, by which they are dealt to tasks."""
    paths = rows.select("img_path").filter(F.col("img_path").isNotNull()).distinct()
    if listing is not None:
        paths = paths.join(listing.select(F.col("path").alias("img_path"), "length"), "img_path", "left")
    return src_images.decode_paths(paths, decoder)


def augmented_images(rows: DataFrame, images: DataFrame) -> DataFrame:
    """The nine variants of every distinct image file of the rows (I6-I8):
    (img_path, variant, variant_rank, variant_path, pixels, ok, error)."""
    out = augment_variants(select_images(rows, images))
    return out.withColumn("variant_path", P.variant_path("img_path", F.col("variant")))


def augment_dataset(clean: DataFrame, images: DataFrame | None,
                    made: DataFrame | None = None) -> DataFrame:
    """Per cleaned row and variant: whether the variant was made (I8).

    Rows: image_id, img_path, node, variant, variant_rank, variant_path, ok,
    error -- pixels live in ``augmented_images`` (one copy per file), which may
    be given as ``made``.  ``node`` is the two-way split of the path list (I18),
    kept for the totals (A12); rows whose file could not be read get no variant
    rows.  The per-file results are one array per path before the join, so a
    path of many rows meets one row and is fanned out after it.
    """
    rows = cat.split_two_nodes(clean.select("image_id", "img_path"), "img_path").drop("ordinal")
    made = made if made is not None else augmented_images(clean, images)
    per_path = made.groupBy("img_path").agg(F.collect_list(F.struct(
        "variant", "variant_rank", "variant_path", "ok", "error")).alias("_made"))
    joined = cleaning.spread_join(rows, per_path, "img_path")
    return joined.select(*rows.columns, F.explode("_made").alias("_one")).select(*rows.columns, "_one.*")


def preprocessed_images(rows: DataFrame, images: DataFrame) -> DataFrame:
    """Preprocessing of every distinct image file of the rows (I20):
    (img_path, status, error, 128x128 pixels)."""
    return preprocess_images(select_images(rows, images))


def preprocess_dataset(rows: DataFrame, images: DataFrame | None,
                       processed: DataFrame | None = None) -> DataFrame:
    """The rows plus ``status``, ``error`` and the result size.

    A row whose path is null or not among the images is SKIPPED; an
    unreadable file is FAILED.  ``processed`` may be a stored
    ``preprocessed_images`` result, otherwise it is computed.
    """
    done = processed if processed is not None else preprocessed_images(rows, images)
    res = done.select("img_path", F.col("status").alias("_status"), F.col("error").alias("_error"),
                      "height", "width")
    out = rows.join(res, on="img_path", how="left")
    return out.select(
        *[c for c in rows.columns],
        F.coalesce("_status", F.lit(STATUS_SKIPPED)).alias("status"),
        F.col("_error").alias("error"), "height", "width")


def _check_adaptive(spark: SparkSession) -> None:
    """Hot keys (a null or repeated image id, a path shared by many rows) are
    split at runtime by AQE's skew join; warn when a session turned it off."""
    import warnings
    on = lambda k: str(spark.conf.get(k, "true")).lower() == "true"
    if not (on("spark.sql.adaptive.enabled") and on("spark.sql.adaptive.skewJoin.enabled")):
        warnings.warn("adaptive execution or its skew join is disabled: a hot image id or path "
                      "would be joined in a single task", RuntimeWarning, stacklevel=3)


def _scan_selected(spark: SparkSession, clean: DataFrame, listing: DataFrame,
                   parts: list[str]) -> DataFrame:
    """The selected files decoded by Spark's ``image`` source.  Listed files that
    the source passes over (zero bytes, hidden names) come as unreadable rows."""
    pixels = select_images(clean, src_images.read_images(spark, parts, recursive=False))
    hidden = P.basename("path").rlike(r"^[_.]")
    passed = listing.filter((F.col("length") == 0) | hidden).select(F.col("path").alias("img_path")).join(
        clean.select("img_path").distinct(), "img_path", "left_semi")
    return pixels.unionByName(passed.select(
        "img_path", *[F.lit(-1).alias(c) for c in _PIXELS[:3]], F.lit(b"").alias("data")))


def prepare_dataset(spark: SparkSession, metadata_csv: str, data_root: str, out_dir: str,
                    fraction: float = DEFAULT_SAMPLE_FRACTION, infer_schema: bool = False,
                    decoder="auto", sample_mode: str = "hash", image_files: bool = False,
                    inventory: DataFrame | None = None) -> dict:
    """The whole run as Spark jobs, writing new tables under ``out_dir`` (never
    touching ``data_root``): ``enriched``, ``clean``, ``quarantine``, ``derived``
    (partitioned by ``kind``: the nine variant suffixes and 'preprocessed'; every
    image file is decoded once for both), ``balanced`` (the variants that bring
    each class up to the largest) and ``reports/<name>``.  Returns the reports.

    All rows are kept unless ``fraction`` lies inside (0, 1).  A part folder may
    be missing; metadata or images missing altogether is an error.
    ``decoder``: a function bytes -> BGR array reads and decodes only the selected
    files, by path on the executors, dealt by their bytes, so only paths are
    shuffled; 'auto' takes an installed one (OpenCV, Pillow).  Without any, or with
    None, Spark's ``image`` source decodes the files under the part folders, and a
    semi join keeps the selected ones.  Both give three-channel images; the source
    passes over hidden names, which come as FAILED rows then.
    ``inventory`` (path, length) replaces the walk of the part folders.
    ``sample_mode``: 'hash' (same rows at any partitioning) or 'bernoulli'
    (Spark's ``sample(False, f, 42)``).  ``image_files`` also writes every made
    variant as a file under ``out_dir/files``.
    """
    _check_adaptive(spark)
    # compare folders the way the listing spells paths (file: URIs stripped)
    parts = cat.part_dirs_under(src_images.local_path_str(data_root))
    raw_all = src_meta.read_metadata_csv(spark, metadata_csv, infer=infer_schema)
    raw = cleaning.sample_fraction(raw_all, fraction, mode=sample_mode)
    if decoder == "auto":
        decoder = src_images.installed_decoder()
    listing = (src_images.list_images(spark, parts, recursive=False) if inventory is None else
               src_images.inventory_files(inventory, parts, recursive=False).filter(P.is_image_name("path")))
    ready = cat.dataset_ready(listing, raw_all, parts)
    state = ready.first()
    if not state.ready:
        raise ValueError(f"data set not ready: {state.asDict()}")
    present = [p for p, n in zip(parts, (state.part1_images, state.part2_images)) if n]
    resolved = cat.resolve_catalog(listing, parts)
    # the enriched rows are written once; clean, quarantine and the cleaning
    # report all read that table instead of re-running CSV parse and joins
    enriched = src_images.materialize(cleaning.enrich(raw, resolved, keep_age_text=True), f"{out_dir}/enriched")
    clean = src_images.materialize(cleaning.keep_clean(enriched), f"{out_dir}/clean")
    quarantine = cleaning.quarantine_null_age(enriched)
    quarantine.write.mode("overwrite").parquet(f"{out_dir}/quarantine")

    # one pass over the selected image files makes both derived products
    selected = (_scan_selected(spark, clean, listing, present) if decoder is None
                else decode_selected(clean, decoder, listing))
    src_images.write_image_table(derive_images(selected), f"{out_dir}/derived",
                                 partition_by=["kind"])
    derived = spark.read.parquet(f"{out_dir}/derived")
    variant_files = (derived.filter(F.col("kind") != PREPROCESSED)
                     .withColumnRenamed("kind", "variant")
                     .withColumn("variant_path", P.variant_path("img_path", F.col("variant"))))
    stored = derived.filter(F.col("kind") == PREPROCESSED)
    made = variant_files.select("img_path", "variant", F.col("kind_rank").alias("variant_rank"),
                                "variant_path", "ok", "error")
    augmented = augment_dataset(clean, None, made=made)
    processed = preprocess_dataset(clean, None, processed=stored)
    if image_files:
        src_images.write_image_files(variant_files.filter("ok"), f"{out_dir}/files").write.format(
            "noop").mode("overwrite").save()
    balanced = src_images.materialize(executed_balance(clean, made), f"{out_dir}/balanced")
    meta = cleaning.cast_metadata(cleaning.project_metadata(raw))

    reports = {
        "dataset_ready": ready,
        "cleaning_delta": cleaning.cleaning_delta(enriched),
        "null_counts": profile.null_counts(clean),
        "schema": profile.schema_report(clean),
        "column_profile": profile.column_profile(clean),
        "dataset_overview": profile.dataset_overview(
            cat.original_images(listing, parts), cat.images_without_label(listing, meta, parts), meta),
        "frequency_report": profile.frequency_report(clean, REPORT_COLUMNS),
        "class_deficit": balance.class_deficit(clean, "dx"),
        "balance_result": balance_result(clean, balanced),
        "describe_age": profile.describe_numeric(clean, "age"),
        "variant_counts": report.variant_counts(
            variant_files.filter("ok").select(F.col("variant_path").alias("path"))),
        "augment_totals": report.augment_totals(augmented),
        "status_counts": report.status_counts(processed),
        "success_rate": report.success_rate(processed),
        "summary": report.run_summary(processed, fraction),
    }
    return {name: src_images.materialize(df, f"{out_dir}/reports/{name}") for name, df in reports.items()}


def executed_balance(clean: DataFrame, made: DataFrame, column: str = "dx") -> DataFrame:
    """The balance plan's rows with the variant made for each: (value, image_id,
    variant, plan_rank, img_path, variant_path, ok); ``ok`` is null where the
    file gave no variants at all."""
    plan = balance.balance_plan(clean, column)
    paths = clean.groupBy("image_id").agg(F.min("img_path").alias("img_path"))
    return (plan.select("value", "image_id", "variant", "plan_rank").join(paths, "image_id", "left")
            .join(made.select("img_path", "variant", "variant_path", "ok"), ["img_path", "variant"], "left"))


def balance_result(clean: DataFrame, balanced: DataFrame, column: str = "dx") -> DataFrame:
    """(value, n, deficit, planned, made, still_missing) per class."""
    done = balanced.groupBy("value").agg(F.count(F.lit(1)).alias("planned"),
                                         F.count_if(F.coalesce("ok", F.lit(False))).alias("made"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return balance.class_deficit(clean, column).join(done, "value", "left").select(
        "value", "n", "deficit", zero("planned").alias("planned"), zero("made").alias("made"),
        (F.col("deficit") - zero("made")).alias("still_missing"))
