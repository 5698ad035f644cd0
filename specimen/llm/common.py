"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specimen.session import ensure_checkpoint_dir, shared_scratch, ship_package

#: The six white-space characters of ``[\x20\x09-\x0D]``, for btrim and for split.
WS_CHARS = " \t\n\x0b\x0c\r"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WS_RUN = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> None:
    """Ready a session given by the caller: shared folder known, package shipped."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage
    so that a lost executor never changes what later stages see.  The files of its
    exchanges go as soon as the table stands, not when the driver's JVM next collects."""
    spark = df.sparkSession
    path = shared_scratch(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def drop_written(*tables: DataFrame) -> None:
    """Delete the folders of tables from ``written`` that nothing reads any more:
    all that was made of them has been written in turn.  Other tables are left."""
    for table in tables:
        path = table.__dict__.pop("_scratch_path", None) if table is not None else None
        if path:
            sc = table.sparkSession.sparkContext
            folder = sc._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else; the fast path serves pure ASCII."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(
        F.translate(c, _UPPER, _LOWER))


def hash128(c: Column) -> list[Column]:
    """Two independently seeded 64-bit hashes: together a 128-bit key."""
    return [F.xxhash64(c).alias("_h1"), F.xxhash64(F.lit(7), c).alias("_h2")]


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text without nulls, as an array."""
    t = trimmed(text)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WS_RUN))


def id_crc(c: Column) -> Column:
    """crc32 of the id written as text; a null id counts as the text ''."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")))


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``mapInArrow`` with a plain function over record batches."""
    return df.mapInArrow(fn, schema)


PARITY_BITS = 1024


def _places(items, bits):
    import numpy as np
    return (items.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % bits


def parity_sketches(doc, items, n: int):
    """A list array of ``PARITY_BITS`` parity bits a set (64 to a long), of ``n`` sets
    given as (doc, item hash) rows.  Two sets that differ in d items differ in at
    most d bits, so the bits in which sketches differ bound d from below."""
    import numpy as np
    import pyarrow as pa
    words, bits = PARITY_BITS // 64, []
    place = _places(items, PARITY_BITS)
    for first in range(0, n, 2_000):  # ``doc`` does not decrease
        some = min(2_000, n - first)
        a, b = np.searchsorted(doc, [first, first + some])
        odd = np.bincount((doc[a:b] - first) * PARITY_BITS + place[a:b], minlength=some * PARITY_BITS) & 1
        bits.append(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64))
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * words),
                                    pa.array(np.concatenate(bits) if bits else np.zeros(0, np.int64)))


FINE_MOST = 1 << 24


def fine_sketches(doc, items, sizes):
    """Parity sketches with two to four bits an item, of the sets for which these are
    more than ``PARITY_BITS``; the others have null.  Lengths are powers of two, so the
    halves of one, each bit added to its twin, are the sketch of half the length."""
    import numpy as np
    import pyarrow as pa
    bits = np.minimum(1 << np.ceil(np.log2(np.maximum(2 * sizes, 2))).astype(np.int64), FINE_MOST)
    bits[bits <= PARITY_BITS] = 0
    upto = np.append(0, np.cumsum(bits))
    use = bits[doc] > 0
    place, times = np.unique(upto[doc[use]] + _places(items[use], bits[doc[use]]), return_counts=True)
    odd = place[times & 1 == 1]
    packed = np.bincount(odd >> 3, 1 << (odd & 7), int(upto[-1]) >> 3).astype(np.uint8)
    starts = pa.array((upto >> 6).astype(np.int32), mask=np.append(bits == 0, False))
    return pa.ListArray.from_arrays(starts, pa.array(packed.view(np.int64)))
