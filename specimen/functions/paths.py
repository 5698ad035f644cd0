"""Path expressions (JVM-side column functions, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from specimen.schema import EXTENSIONS, VARIANT_SUFFIXES

# case-insensitive image rule used for listings
IMAGE_NAME_RULE = r"(?i)\.jpe?g$"
_SPLITEXT = r"^(.*?)([.][^./]*)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def basename(p) -> Column:
    """Last path component."""
    return F.element_at(F.split(_c(p), "/"), -1)


def parent_dir(p) -> Column:
    """Everything before the last '/'."""
    return F.regexp_extract(_c(p), r"^(.*)/[^/]*$", 1)


def stem(p) -> Column:
    """Path without its extension (X3, like ``os.path.splitext(p)[0]``)."""
    return F.regexp_extract(_c(p), _SPLITEXT, 1)


def extension(p) -> Column:
    """Extension with its dot, '' when there is none."""
    return F.regexp_extract(_c(p), _SPLITEXT, 2)


def name_stem(p) -> Column:
    """File name without extension: the image id a file stands for."""
    return stem(basename(p))


def variant_path(p, suffix) -> Column:
    """base + suffix + extension."""
    return F.concat(stem(p), _c(suffix) if not isinstance(suffix, str) else F.lit(suffix),
                    extension(p))


def variant_suffix(p) -> Column:
    """The variant suffix a file name carries right before its extension, else null."""
    alt = "|".join(VARIANT_SUFFIXES)
    s = F.regexp_extract(basename(p), f"({alt})[.][^./]*$", 1)
    return F.when(s == "", F.lit(None).cast("string")).otherwise(s)


def candidate_paths(image_id, part_dirs: list[str]) -> Column:
    """The six lookup candidates in priority order (X1, SURVEY M4)."""
    i = _c(image_id)
    return F.array(*[F.concat(F.lit(d + "/"), i, F.lit(e)) for d in part_dirs for e in EXTENSIONS])


def is_image_name(p) -> Column:
    return _c(p).rlike(IMAGE_NAME_RULE)


def lower_equals(a, b) -> Column:
    """Any-case comparison."""
    return F.lower(_c(a)) == F.lower(_c(b))
