"""Image throughput (images/s) of the augmentation and preprocessing kernels
at a given core count: python scripts/bench_images.py <cores> [sf_dir]."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from specimen.plans import queries as Q  # noqa: E402
from specimen.session import get_session  # noqa: E402


def main():
    cores = int(sys.argv[1])
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = get_session("bench-images", cores=cores, shuffle_partitions=max(2 * cores, 2))
    n = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    out = {"cores": cores, "images": n}
    for name in ("augment_variants", "preprocess_image"):
        fn = Q.QUERIES[name]
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        times = []
        for _ in range(3):
            t = time.perf_counter()
            fn(spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        out[name] = round(n / statistics.median(times), 1)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
