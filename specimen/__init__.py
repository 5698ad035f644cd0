"""specimen — Spark-native preparation and profiling of labelled image collections.

Every public operator is a function ``DataFrame -> DataFrame`` (or takes a few
DataFrames); nothing is collected to the driver inside the library and no input
file is ever modified.  Sub-packages:

* ``sources``   – metadata CSV, image listing, image decode scan, sinks, and the
                  carrier tables built from the driver's parquet data.
* ``functions`` – column expressions (paths, percent, labels) and the numpy
                  pixel kernels that run inside Arrow batches.
* ``operators`` – cleaning, catalog joins, profiling aggregates, class balance,
                  image operators (``mapInArrow``) and run reports.
* ``plans``     – end-to-end jobs (augment, preprocess, full preparation run)
                  and the registry of named queries with their SQL oracles.
* ``llm``       – operators of a training-data pipeline over documents; nothing else
                  imports it.
"""

__all__ = ["session"]
