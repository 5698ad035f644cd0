"""Carrier tables: the driver's parquet tables re-cast in the roles of the
reference's inputs (metadata CSV, image listing, decoded images).

The driver ships no image set, so the roles are played by views derived from
``documents``/``labels`` (metadata) and ``embeddings`` (listing and pixels);
they are written out as SQL in FIXTURES.md and mirrored here with the
DataFrame API.  Every builder reads whole tables; the modulo rules below create
the situations the operators must handle (repeated ids, missing images, copies
in both parts, variant files), they do not shrink the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specimen.functions.codec import arrow_schema
from specimen.schema import IMAGE_SCHEMA, VARIANT_SUFFIXES
from specimen.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _img_id(c):
    return F.concat(F.lit("IMG_"), c.cast("string"))


def meta_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_meta``: typed metadata (image_id, dx, dx_type, sex, age, localization)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    q, t, k = F.col("quality"), F.col("toxic"), F.col("doc_id")
    dx = (F.when(k % 23 == 5, F.lit(None).cast("string")).when(k % 29 == 4, "bcc")
          .otherwise(F.col("lang")))
    labelled = d.join(lab, "doc_id", "left").select(
        _img_id(F.col("doc_id")).alias("image_id"),
        dx.alias("dx"),
        F.when(q == 1, "histo").when(q == 0, "follow_up").alias("dx_type"),
        F.when(k % 17 == 3, F.lit(None).cast("string")).when(t == 1, "female").when(t == 0, "male").alias("sex"),
        F.when(q.isNull(), F.lit(None).cast("double"))
        .otherwise(F.col("n_chars").cast("double")).alias("age"),
        F.col("source").alias("localization"),
    )
    repeated = d.filter(F.col("doc_id") % 50 == 7).select(
        _img_id(F.col("doc_id")).alias("image_id"),
        F.col("lang").alias("dx"),
        F.lit(None).cast("string").alias("dx_type"),
        F.lit(None).cast("string").alias("sex"),
        F.lit(None).cast("double").alias("age"),
        F.col("source").alias("localization"),
    )
    return labelled.unionByName(repeated)


def raw_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_raw_meta``: the metadata as a CSV reader without a schema sees it.

    ``age`` is text (with an unparseable value on some rows) and an extra
    column ``lesion_id`` is present that the six-column projection drops.
    """
    m = meta_view(spark, sf_dir)
    num = F.regexp_extract(F.col("image_id"), r"(\d+)$", 1).cast("long")
    age_txt = (F.when(F.col("age").isNull(), F.lit(None).cast("string"))
               .when(num % 40 == 11, F.lit("unknown"))
               .otherwise(F.col("age").cast("long").cast("string")))
    return m.select(
        F.concat(F.lit("LES_"), (num % 97).cast("string")).alias("lesion_id"),
        "image_id", "dx", "dx_type", "sex", age_txt.alias("age"), "localization")


def _ext(k):
    return (F.when(k % 3 == 0, ".jpg").when(k % 3 == 1, ".JPG").otherwise(".jpeg"))


def catalog_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_catalog``: the image listing (path, part)."""
    k = F.col("vec_id")
    e = table(spark, sf_dir, "embeddings").select("vec_id")
    p_main = (1 + k % 2).cast("int")
    main = e.filter(k % 25 != 24).select(
        F.concat(F.lit("/img/part_"), p_main.cast("string"), F.lit("/IMG_"),
                 k.cast("string"), _ext(k)).alias("path"),
        p_main.alias("part"))
    p_copy = (2 - k % 2).cast("int")
    copies = e.filter(k % 5 == 0).select(
        F.concat(F.lit("/img/part_"), p_copy.cast("string"), F.lit("/IMG_"),
                 k.cast("string"), F.lit(".jpeg")).alias("path"),
        p_copy.alias("part"))
    variants = e.filter(k % 7 == 0).select(
        F.concat(F.lit("/img/part_1/IMG_"), k.cast("string"),
                 F.element_at(F.array(*map(F.lit, VARIANT_SUFFIXES)), (F.floor(k / 7) % 9 + 1).cast("int")),
                 F.lit(".jpg")).alias("path"),
        F.lit(1).cast("int").alias("part"))
    return main.unionByName(copies).unionByName(variants)


def listing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_listing``: every file under the data root (path only).

    The catalog plus files not yet organised into a part: images that are
    missing from the parts, a look-alike folder ``part_10`` and non-image files.
    """
    k = F.col("vec_id")
    e = table(spark, sf_dir, "embeddings").select("vec_id")
    incoming = e.filter(k % 25 == 24).select(
        F.concat(F.lit("/img/incoming/IMG_"), k.cast("string"),
                 F.when(k % 2 == 0, ".jpg").otherwise(".JPEG")).alias("path"))
    lookalike = e.filter(k % 13 == 0).select(
        F.concat(F.lit("/img/part_10/IMG_"), k.cast("string"), F.lit(".jpg")).alias("path"))
    other = e.filter(k % 11 == 0).select(
        F.concat(F.lit("/img/incoming/IMG_"), k.cast("string"), F.lit(".png")).alias("path"))
    return (catalog_view(spark, sf_dir).select("path")
            .unionByName(incoming).unionByName(lookalike).unionByName(other))


# --------------------------------------------------------------------------
# pixel carriers, generated per row by numpy inside Arrow batches

def _synth_pixels(k: int) -> np.ndarray:
    """64x64 RGB, one dark disc; every tenth disc is cut by the left edge."""
    y, x = np.mgrid[0:64, 0:64]
    cx = 2 if k % 10 == 0 else 20 + (k * 7) % 24
    cy = 20 + (k * 11) % 24
    r0 = 8 + k % 7
    n = (k * 31 + y * 17 + x * 13) % 16
    hit = (x - cx) ** 2 + (y - cy) ** 2 <= r0 * r0
    r = np.where(hit, 110, 210) + n
    g = np.where(hit, 60, 180) + n
    b = np.where(hit, 50, 170) + n
    return np.stack([r, g, b], axis=-1).astype(np.uint8)


def _rect_pixels(k: int, emb) -> np.ndarray:
    """Non-square RGB image, h in 24..32, w in 32..42; blue from the embedding."""
    h, w = 24 + k % 9, 32 + (k * 3) % 11
    y, x = np.mgrid[0:h, 0:w]
    e = np.asarray(emb, dtype=np.float64)
    r = (k * 7 + y * 13 + x * 29) % 256
    g = (k * 3 + y * 5 + x * 11 + 100) % 256
    b = np.clip(np.floor((e[(y * 8 + x) % 64] + 1.0) * 127.5), 0, 255)
    return np.stack([r, g, b], axis=-1).astype(np.uint8)


#: images made, and held by a task's Python, at a time
BLOCK_IMAGES = 64


def _rows_to_images(batches, make, junk_rule=None, keep=()):
    schema = arrow_schema(T.StructType([*keep, *IMAGE_SCHEMA.fields]))
    blocks = (rb.slice(at, BLOCK_IMAGES) for rb in batches for at in range(0, rb.num_rows, BLOCK_IMAGES))
    for rb in blocks:
        d = rb.to_pydict()
        out = {f.name: [] for f in IMAGE_SCHEMA.fields} | {f.name: d[f.name] for f in keep}
        for k, emb in zip(d["vec_id"], d.get("embedding", [None] * rb.num_rows)):
            out["image_id"].append(f"IMG_{k}")
            if junk_rule is not None and junk_rule(k):
                # an unreadable file as Spark's image source reports it
                out["height"].append(-1)
                out["width"].append(-1)
                out["n_channels"].append(-1)
                out["data"].append(b"")
                continue
            rgb = make(k, emb)
            out["height"].append(int(rgb.shape[0]))
            out["width"].append(int(rgb.shape[1]))
            out["n_channels"].append(int(rgb.shape[2]))
            out["data"].append(np.ascontiguousarray(rgb[:, :, ::-1]).tobytes())
        yield pa.RecordBatch.from_pydict(out, schema=schema)


def synth_is_junk(k: int) -> bool:
    return k % 50 == 13


def _ids(spark: SparkSession, sf_dir: str, cols, partitions: int | None):
    """embeddings rows, dealt evenly over ``partitions`` tasks *before* the
    pixels are generated, so generation is parallel and no pixel is shuffled;
    rows of one id need not meet, so a much repeated id fills no task."""
    e = table(spark, sf_dir, "embeddings").select(*cols)
    return e.repartition(partitions) if partitions else e


def synth_images(spark: SparkSession, sf_dir: str, with_junk: bool = False,
                 partitions: int | None = None) -> DataFrame:
    """``v_synth`` as an image table (all embeddings rows)."""
    ship_package(spark)
    e = _ids(spark, sf_dir, ["vec_id"], partitions)
    rule = synth_is_junk if with_junk else None
    return e.mapInArrow(lambda it: _rows_to_images(it, lambda k, _: _synth_pixels(k), rule),
                        IMAGE_SCHEMA)


def synth_files(spark: SparkSession, sf_dir: str, paths: DataFrame, with_junk: bool = False,
                partitions: int | None = None) -> DataFrame:
    """(img_path, image): the ``v_synth`` image behind each path of ``paths``
    (img_path, image_id), as a decoder by path would give it.  Ids meet paths
    first and pixels are made after it, so no pixel crosses an exchange."""
    ship_package(spark)
    e = _ids(spark, sf_dir, ["vec_id"], None).withColumn("image_id", _img_id(F.col("vec_id")))
    wanted = e.join(paths, "image_id").select("img_path", "vec_id")
    wanted = wanted.repartition(partitions) if partitions else wanted
    rule = synth_is_junk if with_junk else None
    keep = [T.StructField("img_path", T.StringType())]
    return wanted.mapInArrow(lambda it: _rows_to_images(it, lambda k, _: _synth_pixels(k), rule, keep),
                             T.StructType([*keep, *IMAGE_SCHEMA.fields]))


def rect_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, height, width) of ``v_rect`` without its pixels."""
    k = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        _img_id(k).alias("image_id"), (24 + k % 9).cast("int").alias("height"),
        (32 + (k * 3) % 11).cast("int").alias("width"))


def rect_images(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """``v_rect`` as an image table (all embeddings rows)."""
    ship_package(spark)
    e = _ids(spark, sf_dir, ["vec_id", "embedding"], partitions)
    return e.mapInArrow(lambda it: _rows_to_images(it, _rect_pixels), IMAGE_SCHEMA)
