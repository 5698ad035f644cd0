"""Types and fixed values shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values that must equal the reference's for equal results ---------
# The six metadata columns kept, in order.
METADATA_COLUMNS = ["image_id", "dx", "dx_type", "sex", "age", "localization"]
# Columns profiled by the frequency report, in order.
REPORT_COLUMNS = ["dx", "dx_type", "sex", "localization"]
# The two image folders and the lookup order of extensions inside each.
PART_DIRS = ["part_1", "part_2"]
EXTENSIONS = [".jpg", ".JPG", ".jpeg"]
# Augmentation variants in the reference's order: (name, suffix, parameter).
# Their families and kernels are looked up in VARIANT_FAMILIES below.
VARIANTS = [
    ("rotation_90", "_rot90", 90.0),
    ("rotation_180", "_rot180", 180.0),
    ("rotation_270", "_rot270", 270.0),
    ("brightness_increase", "_bright", 1.3),
    ("brightness_decrease", "_dark", 0.7),
    ("horizontal_flip", "_hflip", None),
    ("vertical_flip", "_vflip", None),
    ("zoom_in", "_zoomin", 1.2),
    ("zoom_out", "_zoomout", 0.8),
]
# Preprocessing constants.
BORDER_RATIO = 0.03
ROI_PAD_RATIO = 0.15
OUT_SIZE = 128
ROI_CLOSE_KERNEL = 7
BG_CLOSE_KERNEL = 9
CLOSE_ITERATIONS = 2
BLUR_KERNEL = 21
ATTENUATION = 0.6
# Status values of the preprocessing job.
STATUS_SUCCESS, STATUS_SKIPPED, STATUS_FAILED = "SUCCESS", "SKIPPED", "FAILED"
# Binary label: classes named malignant by the reference; all others benign.
MALIGNANT_CLASSES = ["bcc"]
# Sampling seed.
SAMPLE_SEED = 42
# Rows shown by DataFrame.show() by default.
SHOW_ROWS = 20
# ---------------------------------------------------------------------------

VARIANT_SUFFIXES = [v[1] for v in VARIANTS]

#: suffix -> (family, kernel name, kernel argument)
VARIANT_FAMILIES = {
    "_rot90": ("rotation", "rotate", 90),
    "_rot180": ("rotation", "rotate", 180),
    "_rot270": ("rotation", "rotate", 270),
    "_bright": ("brightness", "brightness", 1.3),
    "_dark": ("brightness", "brightness", 0.7),
    "_hflip": ("flip_horizontal", "flip", 1),
    "_vflip": ("flip_vertical", "flip", 0),
    "_zoomin": ("zoom", "zoom", 1.2),
    "_zoomout": ("zoom", "zoom", 0.8),
}

#: All rows are kept unless a fraction is asked for.
DEFAULT_SAMPLE_FRACTION = 1.0

# Image table: one row per image; pixels row-major, interleaved, BGR order
# (the byte layout of Spark's ``image`` source and of OpenCV).
IMAGE_FIELDS = [
    T.StructField("image_id", T.StringType(), True),
    T.StructField("height", T.IntegerType(), True),
    T.StructField("width", T.IntegerType(), True),
    T.StructField("n_channels", T.IntegerType(), True),
    T.StructField("data", T.BinaryType(), True),
]
IMAGE_SCHEMA = T.StructType(IMAGE_FIELDS)

# Per-image digest used to compare pixel results between engines.
DIGEST_FIELDS = [
    T.StructField("height", T.IntegerType(), True),
    T.StructField("width", T.IntegerType(), True),
    T.StructField("sum_r", T.LongType(), True),
    T.StructField("sum_g", T.LongType(), True),
    T.StructField("sum_b", T.LongType(), True),
    T.StructField("chk_r", T.LongType(), True),
    T.StructField("chk_g", T.LongType(), True),
    T.StructField("chk_b", T.LongType(), True),
]
