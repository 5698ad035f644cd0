"""Image operators over image tables, run by ``mapInArrow``.

Input: a DataFrame with ``height, width, n_channels, data`` (BGR bytes, the
layout of Spark's ``image`` source) plus any key columns, which pass through.
Each task decodes its images into numpy arrays, runs a kernel and encodes the
result; batches stay small because an image is large.  Kernels never see more
than one image, so a task's memory is bounded by its largest image.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from specimen.functions import kernels as K
from specimen.functions.codec import decode, digest, encode, map_rows
from specimen.schema import (DIGEST_FIELDS, IMAGE_FIELDS, STATUS_FAILED, STATUS_SKIPPED,
                             STATUS_SUCCESS, VARIANT_FAMILIES, VARIANTS)

_IMG = {"height", "width", "n_channels", "data"}


def _keys(df: DataFrame) -> list[T.StructField]:
    """Pass-through columns: all but the pixels and a previous kernel's flags."""
    return [f for f in df.schema.fields if f.name not in _IMG | {"ok", "error"}]


def _passthrough(row: dict, keys) -> dict:
    return {f.name: row[f.name] for f in keys}


def _image_of(row: dict):
    return decode(row.get("height"), row.get("width"), row.get("n_channels"), row.get("data"))


def apply_kernel(images: DataFrame, kernel: Callable[[np.ndarray], np.ndarray],
                 rgb: bool = False) -> DataFrame:
    """Apply ``kernel`` to every image; adds ``ok`` and ``error``.

    ``rgb=True`` hands the kernel RGB and converts its result back to BGR.
    Unreadable images and kernel errors give ``ok = false`` and null pixels.
    """
    keys = _keys(images)
    fields = [*keys, *[f for f in IMAGE_FIELDS if f.name != "image_id" or
                       "image_id" not in {k.name for k in keys}],
              T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType())]
    schema = T.StructType(fields)

    def fn(row):
        out = _passthrough(row, keys)
        img = _image_of(row)
        if img is None:
            out.update(ok=False, error="unreadable image")
            yield out
            return
        try:
            res = K.swap_rb(kernel(K.swap_rb(img))) if rgb else kernel(img)
            out.update(encode(res))
            out.update(ok=True, error=None)
        except Exception as e:  # noqa: BLE001 -- reported per row, never fails the job
            out.update(ok=False, error=f"{type(e).__name__}: {e}")
        yield out

    return map_rows(images, fn, schema)


def recoloured(images: DataFrame, how: dict[int, str], modulus: int) -> DataFrame:
    """Images whose id number modulo ``modulus`` is a key of ``how`` as one-channel
    'grey' (their blue plane) or four-channel 'alpha' (constant opacity)."""
    schema = images.schema

    def fn(row):
        kind = how.get(int(row["image_id"].rpartition("_")[2]) % modulus)
        img = _image_of(row)
        if kind == "grey":
            row = dict(row, **encode(img[:, :, :1]))
        elif kind == "alpha":
            row = dict(row, **encode(np.dstack([img, np.full(img.shape[:2], 128, np.uint8)])))
        yield row

    return map_rows(images, fn, schema)


def image_digest(images: DataFrame) -> DataFrame:
    """Replace the pixels by their exact digest (sizes, sums, weighted sums)."""
    keys = [f for f in _keys(images) if f.name not in ("ok", "error")]
    schema = T.StructType([*keys, *DIGEST_FIELDS])

    def fn(row):
        out = _passthrough(row, keys)
        out.update(digest(_image_of(row)))
        yield out

    return map_rows(images, fn, schema, batch_rows=1024)


def image_scalars(images: DataFrame, fn: Callable[[np.ndarray], dict],
                  fields: list[T.StructField], rgb: bool = True) -> DataFrame:
    """Per-image scalar measurements (threshold, boxes, ...); nulls when unreadable."""
    keys = [f for f in _keys(images) if f.name not in ("ok", "error")]
    schema = T.StructType([*keys, *fields])

    def run(row):
        out = _passthrough(row, keys)
        img = _image_of(row)
        vals = {f.name: None for f in fields}
        if img is not None:
            vals.update(fn(K.swap_rb(img) if rgb else img))
        out.update(vals)
        yield out

    return map_rows(images, run, schema, batch_rows=1024)


VARIANT_KERNELS = {
    suffix: (lambda img, kernel=getattr(K, kernel), arg=arg: kernel(img, arg))
    for suffix, (_, kernel, arg) in VARIANT_FAMILIES.items()}


def _variant_outputs(img):
    """The nine variants of one decoded image (or nine failures)."""
    for rank, (_, suffix, _) in enumerate(VARIANTS, start=1):
        out = {"variant": suffix, "variant_rank": rank}
        if img is None:
            out.update(ok=False, error="unreadable image")
        else:
            try:
                out.update(encode(VARIANT_KERNELS[suffix](img)))
                out.update(ok=True, error=None)
            except Exception as e:  # noqa: BLE001
                out.update(ok=False, error=f"{type(e).__name__}: {e}")
        yield out


def _preprocess_output(row: dict, img) -> dict:
    """Status, error and pixels of one row's preprocessing."""
    if row.get("data") is None and row.get("height") is None:
        return {"status": STATUS_SKIPPED, "error": None}
    if img is None:
        return {"status": STATUS_FAILED, "error": "unreadable image"}
    try:
        out = encode(K.preprocess(img))
        out.update(status=STATUS_SUCCESS, error=None)
        return out
    except Exception as e:  # noqa: BLE001
        return {"status": STATUS_FAILED, "error": f"{type(e).__name__}: {e}"}


def _image_fields(keys):
    names = {k.name for k in keys}
    return [f for f in IMAGE_FIELDS if f.name != "image_id" or "image_id" not in names]


def augment_variants(images: DataFrame) -> DataFrame:
    """Every image x the nine variants, pixels decoded once per image.

    Output rows: keys, ``variant``, ``variant_rank``, image fields, ``ok``,
    ``error``.  A failed variant keeps its row with ``ok = false`` so the
    tally can count it; callers that want only made variants filter ``ok``.
    """
    keys = _keys(images)
    schema = T.StructType([
        *keys, T.StructField("variant", T.StringType()),
        T.StructField("variant_rank", T.IntegerType()), *_image_fields(keys),
        T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType())])

    def fn(row):
        base = _passthrough(row, keys)
        for out in _variant_outputs(_image_of(row)):
            yield dict(base, **out)

    return map_rows(images, fn, schema, batch_rows=16)


def preprocess_images(rows: DataFrame) -> DataFrame:
    """Preprocess every row's image (I20): ``status`` SUCCESS / SKIPPED /
    FAILED and ``error``; pixels are the 128x128 result (null otherwise).

    ``rows`` carries the image fields, null when the row has no image file
    (then SKIPPED).  Unreadable images are FAILED.
    """
    keys = _keys(rows)
    schema = T.StructType([*keys, *_image_fields(keys), T.StructField("status", T.StringType()),
                           T.StructField("error", T.StringType())])

    def fn(row):
        yield dict(_passthrough(row, keys), **_preprocess_output(row, _image_of(row)))

    return map_rows(rows, fn, schema, batch_rows=32)


PREPROCESSED = "preprocessed"


def derive_images(images: DataFrame) -> DataFrame:
    """Both derived products of every image in one pass: the nine variants
    (``kind`` = suffix, ``kind_rank`` 1..9) and the preprocessed image
    (``kind`` = 'preprocessed', ``kind_rank`` 0).  Each image is decoded once.
    ``ok`` is true for a made variant or a SUCCESS; ``status`` is set on the
    preprocessed row only."""
    keys = _keys(images)
    schema = T.StructType([
        *keys, T.StructField("kind", T.StringType()), T.StructField("kind_rank", T.IntegerType()),
        *_image_fields(keys), T.StructField("ok", T.BooleanType()),
        T.StructField("status", T.StringType()), T.StructField("error", T.StringType())])

    def fn(row):
        base = _passthrough(row, keys)
        img = _image_of(row)
        for out in _variant_outputs(img):
            kind, rank = out.pop("variant"), out.pop("variant_rank")
            yield dict(base, kind=kind, kind_rank=rank, status=None, **out)
        pre = _preprocess_output(row, img)
        yield dict(base, kind=PREPROCESSED, kind_rank=0, ok=pre["status"] == STATUS_SUCCESS, **pre)

    return map_rows(images, fn, schema, batch_rows=16)
