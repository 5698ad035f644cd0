"""Session helpers.

The library never creates a session behind the caller's back: operators take
DataFrames.  ``get_session`` is for scripts, tests and the bench; on a cluster
the session comes from ``spark-submit`` and only ``shared_scratch`` is used.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(app: str = "specimen", cores: str | int = "*",
                shuffle_partitions: int = 8) -> SparkSession:
    """Local session with the settings this repo is tested with (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is.  Only a local master (tests) may leave it unset: then a fresh local
    folder is set.  Elsewhere executors would each write to their own disk, so
    an unset folder is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- no SparkContext (Spark Connect client)
        named = spark.conf.get(CHECKPOINT_CONF, None)
        if not named:
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder") from None
        return named
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not named:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="specimen-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint dir for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``specimen`` importable by Python workers (once per application).

    The package is zipped on the driver and added with ``addPyFile``, the
    same mechanism as ``spark-submit --py-files``; Spark copies it to every
    executor.  (Only code goes through this folder, never data.)
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 -- Spark Connect: ship as a session artifact
        sc, app = None, f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    import shutil
    import specimen
    pkg_dir = os.path.dirname(os.path.abspath(specimen.__file__))
    target = tempfile.mkdtemp(prefix="specimen-pyfiles-")
    archive = shutil.make_archive(os.path.join(target, "specimen"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="specimen")
    if sc is not None:
        sc.addPyFile(archive)
    else:
        spark.addArtifacts(archive, pyfile=True)
    _SHIPPED.add(app)
