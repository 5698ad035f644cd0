"""Command line: the whole preparation run.

    spark-submit specimen/plans/prepare.py --metadata /data/metadata.csv \
        --root /data --out /out [--fraction 1.0] [--infer-schema]

Writes ``clean``, ``quarantine``, ``derived``, ``balanced`` and
``reports/<name>`` under ``--out`` and prints the number of rows and the head
of each report.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from specimen.plans.jobs import prepare_dataset  # noqa: E402
from specimen.schema import DEFAULT_SAMPLE_FRACTION, SHOW_ROWS  # noqa: E402
from specimen.session import ensure_checkpoint_dir, ship_package  # noqa: E402
from specimen.sources.images import opencv_decoder, pillow_decoder  # noqa: E402


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--metadata", required=True, help="metadata CSV with a header row")
    ap.add_argument("--root", required=True, help="data root holding part_1/ and part_2/")
    ap.add_argument("--out", required=True, help="output folder for the new tables")
    ap.add_argument("--fraction", type=float, default=DEFAULT_SAMPLE_FRACTION,
                    help="sample fraction; outside (0, 1) keeps every row")
    ap.add_argument("--sample-mode", choices=["hash", "bernoulli"], default="hash",
                    help="hash: by a key hash, the same rows at any partitioning; "
                         "bernoulli: Spark's sample(False, f, 42)")
    ap.add_argument("--infer-schema", action="store_true", help="infer CSV types (extra pass)")
    ap.add_argument("--decoder", choices=["spark", "opencv", "pillow"], default="spark",
                    help="spark: decode scan of the part folders (JVM); opencv / pillow: read "
                         "and decode only the selected files on the executors")
    ap.add_argument("--image-files", action="store_true", help="also write each made variant as a file")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("specimen-prepare").getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    decoder = {"spark": None, "opencv": opencv_decoder, "pillow": pillow_decoder}[args.decoder]
    reports = prepare_dataset(spark, args.metadata, args.root, args.out, args.fraction,
                              infer_schema=args.infer_schema, decoder=decoder,
                              sample_mode=args.sample_mode, image_files=args.image_files)
    for name, df in reports.items():
        print(f"\n== {name}: {df.count()} rows, all in {args.out}/reports/{name}")
        df.show(SHOW_ROWS, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
