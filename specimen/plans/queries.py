"""Named queries: every operator of the survey run over the carrier tables
built from the driver's parquet data (whole tables, no id subsets).

Each entry is ``fn(spark, sf_dir) -> DataFrame``; ``specimen.plans.oracle``
holds the equivalent DuckDB SQL under the same key and column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specimen.functions import kernels as K
from specimen.functions import paths as P
from specimen.functions import scalar as S
from specimen.operators import balance, catalog as cat, cleaning, profile, report
from specimen.operators import images as ops
from specimen.plans import jobs
from specimen.schema import OUT_SIZE, REPORT_COLUMNS, VARIANT_FAMILIES, VARIANT_SUFFIXES, VARIANTS
from specimen.session import shared_scratch
from specimen.sources import carriers as C
from specimen.sources import images as src_images
from specimen.sources import metadata as src_meta

ROOT = "/img"
PARTS = cat.part_dirs_under(ROOT)
FRACTION = 0.05

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- building blocks

def _raw(s, sf):
    return C.raw_meta(s, sf)


def _resolved(s, sf):
    return cat.resolve_catalog(C.catalog_view(s, sf), PARTS)


def _enriched(s, sf):
    return cleaning.enrich(_raw(s, sf), _resolved(s, sf))


def _clean(s, sf):
    return cleaning.clean_and_enrich(_raw(s, sf), _resolved(s, sf))


#: images a task makes: all of them may wait between two operators' Python at once
TASK_IMAGES = 1024


def _parts(s, sf) -> int:
    """Carrier images come from one small parquet file: their ids are spread
    before pixels are generated -- pixel work is CPU-bound -- over at least one
    partition per core and as many as keep ``TASK_IMAGES`` images to a task, so
    that its memory does not grow with the table; with an explicit count, so AQE
    does not coalesce them back into one task."""
    try:
        least = int(s.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 -- no SparkContext (Spark Connect)
        least = int(s.conf.get("spark.sql.shuffle.partitions"))
    return max(1, least, -(-C.table(s, sf, "embeddings").count() // TASK_IMAGES))


def _rect(s, sf):
    return C.rect_images(s, sf, partitions=_parts(s, sf))


def _synth(s, sf, junk=False):
    return C.synth_images(s, sf, with_junk=junk, partitions=_parts(s, sf))


def _decoded(s, sf, rows: DataFrame) -> DataFrame:
    """The decoded images of the distinct files the rows point at, by path:
    ids and paths meet first, pixels are made after it (as ``decode_paths``)."""
    paths = rows.filter(F.col("img_path").isNotNull()).select("img_path", "image_id").distinct()
    return C.synth_files(s, sf, paths, with_junk=True, partitions=_parts(s, sf)).drop("image_id")


def _digest_of(images: DataFrame) -> DataFrame:
    return ops.image_digest(images.filter(F.col("ok")) if "ok" in images.columns else images)


# ---------------------------------------------------------------- 2.1 sources

@query
def scan_csv_metadata(s, sf):
    path = shared_scratch(s, "meta-csv")
    src_meta.write_metadata_csv(C.meta_view(s, sf), path)
    return cleaning.cast_metadata(cleaning.project_metadata(src_meta.read_metadata_csv(s, path)))


@query
def scan_image_catalog(s, sf):
    """Every path of the listing written as a file (even ids empty, odd ids
    one byte) under a scratch folder and listed back by the lister."""
    folder = shared_scratch(s, "files")
    wanted = C.listing_view(s, sf).select("path", F.substring("path", 2, 4096).alias("name"),
                                          F.lit(0).alias("height"), F.lit(0).alias("width"),
                                          F.lit(0).alias("n_channels"),
                                          F.when(F.crc32("path") % 2 == 0, F.lit(b"")).otherwise(F.lit(b"x")).alias("data"))
    src_images.write_image_files(wanted, folder, name_col="name", ext="").write.format("noop").mode("overwrite").save()
    listed = src_images.list_images(s, [folder]).select(
        F.regexp_extract("path", r"(/img/.*)$", 1).alias("path"))
    return cat.image_listing(listed)


@query
def write_image_table(s, sf):
    path = shared_scratch(s, "variants")
    aug = ops.augment_variants(_rect(s, sf))
    src_images.write_image_table(aug, path, partition_by=["variant"])
    back = src_images.read_image_table(s, path)
    return _digest_of(back.select("image_id", "variant", "height", "width", "n_channels",
                                  "data", "ok"))


@query
def scan_image_pixels(s, sf):
    """S3: the rect images written as PNG files (unreadable bytes for
    vec_id % 50 = 13, zero bytes for vec_id % 50 = 29, grey for 17, an alpha
    channel for 31), decoded back by Spark's image source, reduced to digests."""
    folder = shared_scratch(s, "png")
    imgs = ops.recoloured(C.rect_images(s, sf, partitions=_parts(s, sf)), {17: "grey", 31: "alpha"}, 50)
    k = F.regexp_extract("image_id", r"(\d+)$", 1).cast("long")
    imgs = imgs.select(
        "image_id",
        *[F.when(k % 50 == 13, F.lit(-1)).otherwise(F.col(c)).alias(c)
          for c in ("height", "width", "n_channels")],
        F.when(k % 50 == 13, F.lit(b"not an image at all")).when(k % 50 == 29, F.lit(b""))
        .otherwise(F.col("data")).alias("data"))
    src_images.write_image_files(imgs, folder).write.format("noop").mode("overwrite").save()
    decoded = src_images.read_images(s, [folder], glob="*.png")
    return ops.image_digest(decoded.select("image_id", "height", "width", "n_channels", "data"))


@query
def locate_file_ci(s, sf):
    return cat.locate_file_ci(C.listing_view(s, sf))


@query
def dataset_ready(s, sf):
    return cat.dataset_ready(C.listing_view(s, sf), C.meta_view(s, sf), PARTS)


@query
def organize_parts(s, sf):
    return cat.organize_parts(C.listing_view(s, sf), PARTS)


@query
def schema_report(s, sf):
    return profile.schema_report(_clean(s, sf))


@query
def materialize_once(s, sf):
    return src_images.materialize(_clean(s, sf), shared_scratch(s, "clean"))


# ---------------------------------------------------------------- 2.2 projections, filters

@query
def project_metadata(s, sf):
    return cleaning.project_metadata(_raw(s, sf))


@query
def cast_id_string(s, sf):
    return cleaning.cast_metadata(cleaning.project_metadata(_raw(s, sf))).select("image_id")


@query
def cast_age_double(s, sf):
    raw = cleaning.project_metadata(_raw(s, sf)).select("image_id", F.col("age").alias("age_text"))
    return raw.select("image_id", "age_text", F.col("age_text").try_cast("double").alias("age"))


@query
def with_img_path(s, sf):
    return _enriched(s, sf)


@query
def null_label(s, sf):
    return _enriched(s, sf).select("image_id", S.null_label("sex").alias("sex_label"))


@query
def filter_age_present(s, sf):
    return cleaning.filter_age_present(_enriched(s, sf))


@query
def filter_has_image(s, sf):
    return cleaning.filter_has_image(_enriched(s, sf))


@query
def filter_age_missing(s, sf):
    return cleaning.filter_age_missing(_enriched(s, sf))


@query
def filter_null_any(s, sf):
    return cleaning.filter_null_any(_enriched(s, sf), "dx_type")


@query
def sample_fraction(s, sf):
    return cleaning.sample_fraction(_enriched(s, sf), FRACTION)


@query
def filter_path_exists(s, sf):
    return cleaning.filter_path_exists(_enriched(s, sf), C.listing_view(s, sf))


@query
def quarantine_null_age(s, sf):
    return cleaning.quarantine_null_age(_enriched(s, sf))


@query
def clean_and_enrich(s, sf):
    return _clean(s, sf)


@query
def skip_missing_image(s, sf):
    return cleaning.skip_missing_image(_enriched(s, sf), C.listing_view(s, sf))


# ---------------------------------------------------------------- 2.3 joins

@query
def resolve_image_path(s, sf):
    return _resolved(s, sf)


@query
def images_with_metadata(s, sf):
    meta = cleaning.cast_metadata(cleaning.project_metadata(_raw(s, sf)))
    return cat.metadata_with_image(meta, _resolved(s, sf))


@query
def metadata_without_image(s, sf):
    meta = cleaning.cast_metadata(cleaning.project_metadata(_raw(s, sf)))
    return cat.metadata_without_image(meta, _resolved(s, sf))


@query
def images_without_label(s, sf):
    return cat.images_without_label(C.listing_view(s, sf), C.meta_view(s, sf), PARTS)


@query
def anti_quarantine(s, sf):
    return cleaning.anti_quarantine(_enriched(s, sf))


@query
def candidate_paths(s, sf):
    return cat.candidate_table(cleaning.project_metadata(_raw(s, sf)), PARTS)


# ---------------------------------------------------------------- 2.4 aggregations

@query
def row_count(s, sf):
    return profile.row_count(_clean(s, sf))


@query
def cleaning_delta(s, sf):
    return cleaning.cleaning_delta(cleaning.enrich(_raw(s, sf), _resolved(s, sf), keep_age_text=True))


@query
def null_counts(s, sf):
    return profile.null_counts(_enriched(s, sf))


@query
def null_count_column(s, sf):
    return profile.null_count_column(_enriched(s, sf), "sex")


@query
def distinct_values(s, sf):
    return profile.distinct_values(_clean(s, sf), "dx")


@query
def class_frequency(s, sf):
    return profile.class_frequency(_clean(s, sf), "dx")


@query
def frequency_report(s, sf):
    return profile.frequency_report(_clean(s, sf), REPORT_COLUMNS)


@query
def column_stats(s, sf):
    return profile.column_stats(_clean(s, sf), REPORT_COLUMNS)


@query
def describe_age(s, sf):
    return profile.describe_numeric(_clean(s, sf), "age")


def _preprocessed(s, sf):
    """Rows with an age, with or without an image (SKIPPED), written once."""
    rows = src_images.materialize(cleaning.filter_age_present(_enriched(s, sf)), shared_scratch(s, "rows"))
    return jobs.preprocess_dataset(rows, None, processed=ops.preprocess_images(_decoded(s, sf, rows)))


@query
def status_counts(s, sf):
    return report.status_counts(_preprocessed(s, sf))


@query
def success_rate(s, sf):
    return report.success_rate(_preprocessed(s, sf))


@query
def variant_counts(s, sf):
    return report.variant_counts(C.listing_view(s, sf))


def _augmented(s, sf):
    rows = src_images.materialize(_clean(s, sf), shared_scratch(s, "rows"))
    made = ops.augment_variants(_decoded(s, sf, rows)).withColumn(
        "variant_path", P.variant_path("img_path", F.col("variant")))
    return jobs.augment_dataset(rows, None, made=made)


@query
def augment_totals(s, sf):
    return report.augment_totals(_augmented(s, sf))


@query
def run_summary(s, sf):
    final = _preprocessed(s, sf).drop("height", "width")
    return report.run_summary(final, FRACTION)


@query
def dataset_overview(s, sf):
    listing, meta = C.listing_view(s, sf), C.meta_view(s, sf)
    return profile.dataset_overview(cat.original_images(listing, PARTS),
                                    cat.images_without_label(listing, meta, PARTS), meta)


@query
def column_profile(s, sf):
    return profile.column_profile(_clean(s, sf))


@query
def class_deficit(s, sf):
    return balance.class_deficit(_clean(s, sf), "dx")


@query
def balance_plan(s, sf):
    return balance.balance_plan(_clean(s, sf), "dx")


# ---------------------------------------------------------------- 2.6 sorts

@query
def order_by_count(s, sf):
    return profile.class_frequency(_clean(s, sf), "localization").select("value", "n", "rank")


@query
def head_rows(s, sf):
    rep = profile.frequency_report(_clean(s, sf), REPORT_COLUMNS)
    return profile.head_rows(rep, ["column_name", "rank"]).select("column_name", "value", "n", "rank")


# ---------------------------------------------------------------- 2.7 set operations

@query
def union_listings(s, sf):
    return cat.union_listings(C.listing_view(s, sf))


@query
def union_parts(s, sf):
    return cat.union_parts(C.listing_view(s, sf), PARTS)


@query
def images_to_organize(s, sf):
    return cat.images_to_organize(C.listing_view(s, sf), PARTS)


# ---------------------------------------------------------------- 2.8 scalar functions

@query
def path_basename(s, sf):
    return C.listing_view(s, sf).select("path", P.basename("path").alias("name"))


@query
def path_splitext(s, sf):
    return C.listing_view(s, sf).select("path", P.stem("path").alias("stem"),
                                        P.extension("path").alias("ext"))


@query
def variant_path(s, sf):
    rows = _clean(s, sf).select("image_id", "img_path")
    sfx = F.explode(F.array(*[F.lit(v) for v in VARIANT_SUFFIXES])).alias("variant")
    fan = rows.select("image_id", "img_path", sfx)
    return fan.select("image_id", "variant", P.variant_path("img_path", F.col("variant"))
                      .alias("variant_path"))


@query
def lower_equals(s, sf):
    lst = C.listing_view(s, sf)
    return lst.filter(P.lower_equals(P.basename("path"),
                                     F.concat(P.name_stem("path"), F.lit(".jpg")))).select("path")


@query
def variant_family(s, sf):
    files = C.listing_view(s, sf).select("path", P.variant_suffix("path").alias("variant")) \
        .filter(F.col("variant").isNotNull())
    dims = s.createDataFrame([(suffix, name, VARIANT_FAMILIES[suffix][0]) for name, suffix, _ in VARIANTS],
                             "variant string, transform string, family string")
    return files.join(F.broadcast(dims), "variant").select("path", "variant", "transform", "family")


@query
def percent_of_total(s, sf):
    return profile.class_frequency(_clean(s, sf), "sex").select("value", "n", "percent")


@query
def format_percent(s, sf):
    return profile.class_frequency(_clean(s, sf), "dx_type").select("value", "percent_text")


@query
def half_split_sizes(s, sf):
    n = cat.images_to_organize(C.listing_view(s, sf), PARTS).agg(F.count(F.lit(1)).alias("n"))
    first, second = S.half_sizes(F.col("n"))
    return n.select("n", first.alias("ceil_half"), second.alias("floor_half"))


@query
def int_trunc(s, sf):
    sizes = C.rect_sizes(s, sf)
    return sizes.select(
        "image_id", S.int_trunc("height", 0.03).alias("border_y"),
        S.int_trunc("width", 0.03).alias("border_x"),
        F.floor(F.col("height") / F.lit(1.2)).cast("int").alias("zoom_in_h"),
        S.int_trunc("height", 0.8).alias("zoom_out_h"),
        S.int_trunc("width", 0.15).alias("pad_x"))


@query
def clamp(s, sf):
    return _clean(s, sf).select("image_id", S.clamp("age", 100.0, 10000.0).alias("age_clamped"))


@query
def binary_label(s, sf):
    return balance.binary_label_counts(_clean(s, sf), "dx")


@query
def upper_title(s, sf):
    rep = profile.column_stats(_clean(s, sf), REPORT_COLUMNS)
    return rep.select("column_name", S.upper_title("column_name").alias("title"))


# ---------------------------------------------------------------- 2.9 image operators

def _kernel_query(kernel, source="rect", rgb=False):
    def q(s, sf):
        imgs = _rect(s, sf) if source == "rect" else _synth(s, sf)
        return _digest_of(ops.apply_kernel(imgs, kernel, rgb=rgb))
    return q


QUERIES["img_rotate_90"] = _kernel_query(lambda i: K.rotate(i, 90))
QUERIES["img_rotate_180"] = _kernel_query(lambda i: K.rotate(i, 180))
QUERIES["img_rotate_270"] = _kernel_query(lambda i: K.rotate(i, 270))
QUERIES["img_bright"] = _kernel_query(lambda i: K.brightness(i, 1.3))
QUERIES["img_dark"] = _kernel_query(lambda i: K.brightness(i, 0.7))
QUERIES["img_hflip"] = _kernel_query(lambda i: K.flip(i, 1))
QUERIES["img_vflip"] = _kernel_query(lambda i: K.flip(i, 0))
QUERIES["img_zoom_in"] = _kernel_query(lambda i: K.zoom(i, 1.2))
QUERIES["img_zoom_out"] = _kernel_query(lambda i: K.zoom(i, 0.8))
QUERIES["img_bgr_rgb"] = _kernel_query(K.swap_rb)
QUERIES["img_center_square"] = _kernel_query(K.center_square)
QUERIES["img_resize_area"] = _kernel_query(lambda i: K.resize_area(i, OUT_SIZE, OUT_SIZE))
QUERIES["img_resize_area_down"] = _kernel_query(lambda i: K.resize_area(i, 12, 20))
QUERIES["img_border_crop"] = _kernel_query(K.border_crop, source="synth")


def _grey(fn):
    return lambda rgb: fn(rgb)[:, :, None]


QUERIES["img_pigment_score"] = _kernel_query(_grey(K.pigment_score), source="synth", rgb=True)
QUERIES["img_morph_close"] = _kernel_query(
    _grey(lambda rgb: (K.lesion_mask(rgb, 7) * 255).astype("uint8")), source="synth", rgb=True)
QUERIES["img_gaussian_blur"] = _kernel_query(
    _grey(lambda rgb: K.gaussian_blur((K.lesion_mask(rgb, 9) * 255).astype("uint8"))),
    source="synth", rgb=True)
QUERIES["img_attenuate_bg"] = _kernel_query(K.attenuate_background, source="synth", rgb=True)


@query
def preprocess_image(s, sf):
    return _digest_of(ops.apply_kernel(_synth(s, sf), K.preprocess))


@query
def augment_variants(s, sf):
    return _digest_of(ops.augment_variants(_rect(s, sf)).drop("variant_rank"))


@query
def augment_status(s, sf):
    return ops.augment_variants(_synth(s, sf, junk=True)).select("image_id", "variant", "ok")


@query
def augment_dataset(s, sf):
    aug = _augmented(s, sf)
    return aug.groupBy("node", "variant").agg(
        F.count_if(F.col("ok")).alias("n_ok"), F.count_if(~F.col("ok")).alias("n_failed"))


_INT = T.IntegerType()


@query
def img_otsu_threshold(s, sf):
    return ops.image_scalars(_synth(s, sf), lambda rgb: {
        "threshold": K.otsu_threshold(K.pigment_score(rgb))}, [T.StructField("threshold", _INT)])


@query
def largest_component(s, sf):
    def fn(rgb):
        best = K.largest_component(K.lesion_mask(K.border_crop(rgb), 7))
        keys = ("area", "x", "y", "bw", "bh", "n_pixels")
        return dict(zip(keys, best)) if best else {}
    fields = [T.StructField("area", T.DoubleType())] + [
        T.StructField(n, _INT) for n in ("x", "y", "bw", "bh", "n_pixels")]
    return ops.image_scalars(_synth(s, sf), fn, fields)


@query
def img_roi_box(s, sf):
    def fn(rgb):
        return dict(zip(("x0", "y0", "x1", "y1"), K.roi_box(K.border_crop(rgb))))
    return ops.image_scalars(_synth(s, sf), fn, [T.StructField(n, _INT) for n in
                                                 ("x0", "y0", "x1", "y1")])


@query
def preprocess_dataset(s, sf):
    return _preprocessed(s, sf).select("image_id", "img_path", "status", "height", "width")


@query
def split_two_nodes(s, sf):
    return cat.split_two_nodes(_clean(s, sf).select("image_id", "img_path"), "img_path") \
        .select("image_id", "img_path", "node")
