"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed completely with the ``noop`` sink (every row and
column computed, nothing collected); one warm-up run, then the median of
``BENCH_REPEAT`` runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from specimen.operators import profile  # noqa: E402
from specimen.plans import queries as Q  # noqa: E402
from specimen.schema import REPORT_COLUMNS  # noqa: E402
from specimen.session import get_session  # noqa: E402

HEADLINE = [
    "clean_and_enrich", "resolve_image_path", "frequency_report", "class_frequency",
    "column_profile", "cleaning_delta", "balance_plan", "augment_variants", "preprocess_image",
    "augment_dataset", "preprocess_dataset",
]


def frequency_report_unfused(s, sf):
    """The report's parts by separate operators, column by column (for comparison)."""
    clean = Q._clean(s, sf)
    parts = [profile.class_frequency(clean, c).select("value", "n", "rank") for c in REPORT_COLUMNS]
    parts += [profile.column_stats(clean, [c]).select(
        F.col("column_name").alias("value"), F.col("total_rows").alias("n"), F.col("n_distinct").alias("rank"))
        for c in REPORT_COLUMNS]
    for part in parts:
        part.write.format("noop").mode("overwrite").save()
    return parts[0].limit(0)


def run(fn, spark, sf):
    t = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session("specimen-bench", cores=cpus, shuffle_partitions=max(2 * cpus, 8))
    timings = {}
    fns = {name: Q.QUERIES[name] for name in HEADLINE}
    fns["frequency_report_unfused"] = frequency_report_unfused
    for name, fn in fns.items():
        run(fn, spark, sf)  # warm-up
        timings[name] = round(statistics.median(run(fn, spark, sf) for _ in range(repeat)), 3)
    n_images = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    total = round(sum(v for k, v in timings.items() if k in HEADLINE), 3)
    # the reference's whole run on real files (outside the headline total)
    from scripts.bench_prepare import build_root, time_prepare
    root, csv = build_root(spark, sf, cpus)
    prep_sec, kept = time_prepare(spark, root, csv)
    print(json.dumps({
        "metric": "headline_total", "value": total, "unit": "sec", "queries": timings,
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""), "cpus": cpus,
        "images_per_sec": {
            "augment_variants": round(n_images / timings["augment_variants"], 1),
            "preprocess_image": round(n_images / timings["preprocess_image"], 1),
            "prepare_run": round(kept / prep_sec, 1),
        },
        "prepare_run": {"sec": round(prep_sec, 3), "images_kept": kept},
    }))


if __name__ == "__main__":
    main()
