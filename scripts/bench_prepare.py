"""End-to-end timing of the full preparation run on real files.

    python scripts/bench_prepare.py <cores> [sf_dir]

Builds a data root in a new folder under the shared checkpoint folder
(``spark.checkpoint.dir``) from the driver tables: every
``v_synth`` image written as a PNG file ``part_<1 + k % 2>/IMG_<k>.jpg`` (PNG
bytes under a .jpg name; Spark's decoder reads by content) and the
``v_raw_meta`` rows as the metadata CSV.  Then times ``prepare_dataset``
(listing, cleaning, reports, nine variants and preprocessing of every kept
image, all tables written).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from specimen.plans.jobs import prepare_dataset  # noqa: E402
from specimen.session import get_session, shared_scratch  # noqa: E402
from specimen.sources import carriers as C  # noqa: E402
from specimen.sources import images as src  # noqa: E402
from specimen.sources import metadata as meta  # noqa: E402


def build_root(spark, sf: str, cores: int) -> tuple[str, str]:
    """A data root of image files and a metadata CSV derived from the tables."""
    root = shared_scratch(spark, "bench-root")
    imgs = C.synth_images(spark, sf, partitions=cores)
    k = F.regexp_extract("image_id", r"(\d+)$", 1).cast("long")
    for part in (1, 2):
        subset = imgs.filter(1 + k % 2 == part)
        src.write_image_files(subset, f"{root}/part_{part}", ext=".jpg").write.format(
            "noop").mode("overwrite").save()
    csv = f"{root}/metadata_csv"
    meta.write_metadata_csv(C.raw_meta(spark, sf).coalesce(1), csv)
    return root, csv


def time_prepare(spark, root: str, csv: str, repeat: int = 2) -> tuple[float, int]:
    """Best wall time of the whole run (all tables written, all reports
    computed) and the number of kept images."""
    runs, out = [], None
    for _ in range(repeat):
        out = shared_scratch(spark, "bench-out")
        t = time.perf_counter()
        reports = prepare_dataset(spark, csv, root, out, fraction=1.0, decoder=None)
        for df in reports.values():
            df.collect()
        runs.append(time.perf_counter() - t)
    return min(runs), spark.read.parquet(f"{out}/clean").count()


def main():
    cores = int(sys.argv[1]) if len(sys.argv) > 1 else 8
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = get_session("bench-prepare", cores=cores, shuffle_partitions=max(2 * cores, 8))
    root, csv = build_root(spark, sf, cores)
    best, kept = time_prepare(spark, root, csv)
    print(json.dumps({"cores": cores, "sf": sf, "images_kept": kept, "prepare_sec": round(best, 2),
                      "images_per_sec": round(kept / best, 1)}))


if __name__ == "__main__":
    main()
