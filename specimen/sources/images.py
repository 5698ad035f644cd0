"""Image files: listing, decode scan and the derived-image sink."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specimen.functions import paths as P
from specimen.schema import IMAGE_FIELDS

# A glob that no spelling of the extensions escapes; the exact case-insensitive
# rule is applied afterwards.
IMAGE_GLOB = "*.[jJ][pP]*[gG]"

# hash buckets a task when files are dealt by bytes; what opening a file costs, in bytes
_FINE, _OPEN_COST = 64, 4096


def local_path(c) -> F.Column:
    """``file:/x``, ``file:///x`` -> ``/x`` so listings, image origins and
    metadata paths compare equal; other schemes (hdfs://, s3a://) are kept."""
    return F.regexp_replace(c, r"^file:/+", "/")


def local_path_str(path: str) -> str:
    """Python twin of ``local_path`` for paths given by the caller."""
    import re
    return re.sub(r"^file:/+", "/", path)


_ENTRY = "path string, length long, is_dir boolean"


def _open(uri: str):
    """(file system, path inside it, prefix that turns paths back into URIs)."""
    from pyarrow import fs as pafs
    uri = local_path_str(uri)
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri, ""
    filesystem, inner = pafs.FileSystem.from_uri(uri)
    return filesystem, inner, uri[:len(uri) - len(inner)] if uri.endswith(inner) else ""


_PAGE = 10_000


def _list_folders(batches):
    """One level: the entries of every folder of a batch, a page at a time; a missing
    one has none.  A local folder is read as a stream of names, whose sizes
    ``_sizes`` adds; other stores give sizes with the names."""
    import os

    import pyarrow as pa
    from pyarrow import fs as pafs
    kinds = pa.schema([("path", pa.string()), ("length", pa.int64()), ("is_dir", pa.bool_())])

    def entries(folder):
        filesystem, inner, prefix = _open(folder)
        if isinstance(filesystem, pafs.LocalFileSystem):
            try:
                with os.scandir(inner) as found:
                    for e in found:
                        yield prefix + os.path.join(inner, e.name), None, e.is_dir()
            except (FileNotFoundError, NotADirectoryError):
                return
        else:
            for f in filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True)):
                yield prefix + f.path, f.size, f.type == pafs.FileType.Directory

    for rb in batches:
        page = []
        for folder in rb.column(0).to_pylist():
            for e in entries(folder):
                page.append(e)
                if len(page) == _PAGE:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*page), kinds)], schema=kinds)
                    page = []
        if page:
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*page), kinds)], schema=kinds)


def _sizes(batches):
    """(path, length) of local files; one that is gone by now has no row."""
    import os

    import pyarrow as pa
    for rb in batches:
        paths, sizes = [], []
        for path in rb.column(0).to_pylist():
            try:
                sizes.append(os.stat(path).st_size)
                paths.append(path)
            except FileNotFoundError:
                continue
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "length"])


def list_files(spark: SparkSession, roots: list[str], recursive: bool = True) -> DataFrame:
    """(path, length) of every file under ``roots``; zero-byte files and names
    starting with '_' or '.' are listed, a missing root is empty.

    The folders of one level are spread over tasks, which list them (local, HDFS,
    S3) in pages; the driver only holds the given roots.  The names of one flat
    folder come from one task, as a stream that is never held whole; their sizes,
    a request per file, are read by all tasks.  Every level is written to the
    shared folder, so the listing does not change under later reads.  A store's
    own inventory spares the walk: see ``inventory_files``.
    """
    from specimen.session import shared_scratch, ship_package
    ship_package(spark)
    folders = spark.createDataFrame([(local_path_str(r).rstrip("/") or "/",) for r in roots], "path string")
    files = spark.createDataFrame([], "path string, length long")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        level = materialize(folders.repartition(tasks, "path").mapInArrow(_list_folders, _ENTRY),
                            shared_scratch(spark, "listing"))
        files = files.unionByName(level.filter(~F.col("is_dir")).select("path", "length"))
        folders = level.filter("is_dir").select("path")
        if not recursive or folders.isEmpty():
            break
    # an explicit count: adaptive execution would gather the short names in one task
    unsized = files.filter("length is null").select("path").repartition(tasks, "path")
    sized = materialize(unsized.mapInArrow(_sizes, "path string, length long"), shared_scratch(spark, "sizes"))
    return files.filter("length is not null").unionByName(sized)


def inventory_files(inventory: DataFrame, roots: list[str], recursive: bool = True,
                    path_col: str = "path", length_col: str = "length") -> DataFrame:
    """The listing of ``roots`` from an inventory table (a store's own report, or a
    listing written before) instead of a walk: the rows that ``list_files`` gives.

    A path of several rows (versions, repeated reports) is listed once with its
    largest length; null paths and folder markers (names ending in '/') are left
    out, a null length counts as 0."""
    rows = inventory.select(local_path(F.col(path_col)).alias("path"), F.coalesce(
        F.col(length_col).cast("long"), F.lit(0)).alias("length")).filter("path is not null and not endswith(path, '/')")
    inside = F.lit(False)
    for root in roots:
        base = local_path_str(root).rstrip("/")
        inside = inside | (F.startswith(F.col("path"), F.lit(base + "/")) if recursive else P.parent_dir("path") == base)
    return rows.filter(inside).groupBy("path").agg(F.max("length").alias("length"))


def list_images(spark: SparkSession, roots: list[str], recursive: bool = True) -> DataFrame:
    """Image files under ``roots`` by the case-insensitive name rule."""
    return list_files(spark, roots, recursive).filter(P.is_image_name("path"))


def _canonical(row: dict) -> dict:
    """A decoded row with three BGR channels; unreadable rows stay as they are."""
    from specimen.functions.codec import decode, encode, three_channels
    img = decode(row["height"], row["width"], row["n_channels"], row["data"])
    return dict(row, **encode(three_channels(img))) if img is not None else row


def read_images(spark: SparkSession, roots: list[str], glob: str | None = IMAGE_GLOB,
                recursive: bool = True) -> DataFrame:
    """Decode images with Spark's ``image`` source (S3).

    Returns (path, image_id, height, width, n_channels, data) with BGR bytes of
    three channels (grey repeated, alpha dropped); a file that cannot be decoded
    has height -1 and empty data (it is not an error), which later operators
    report as a failure.  Spark's source passes over zero-byte and hidden files.
    """
    from specimen.functions.codec import map_rows
    r = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(roots)
    path = local_path("image.origin")
    rows = df.select(
        path.alias("path"),
        P.name_stem(path).alias("image_id"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("n_channels"),
        F.col("image.data").alias("data"),
    )
    schema = T.StructType([T.StructField("path", T.StringType()), *IMAGE_FIELDS])
    return map_rows(rows, lambda row: [_canonical(row)], schema)


def write_image_table(images: DataFrame, path: str, partition_by: list[str] | None = None,
                      mode: str = "overwrite") -> None:
    """Write derived images as parquet, never over the inputs.

    Pixels are stored raw (no lossy re-encode, M22) and compressed with zstd.
    """
    w = images.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_image_files(images: DataFrame, folder: str, name_col: str | None = None,
                      ext: str = ".png") -> DataFrame:
    """Write every image as a lossless PNG file ``<folder>/<name><ext>`` from the
    executors.  The name is ``name_col``, else the whole image path without its
    extension where the rows carry one (``img_path`` or ``path``: files of one id
    in several folders stay apart), else ``image_id``; it may hold folders.
    Returns a lazy (path, n_bytes) table; run an action on it to write.
    Unreadable images are written as they came (their original bytes), so a
    decode of the folder reports them again.  ``folder`` may be any URI that
    ``pyarrow.fs`` resolves (local, HDFS, S3).
    """
    from specimen.functions.codec import decode, map_rows, png_encode

    schema = T.StructType([T.StructField("path", T.StringType()),
                           T.StructField("n_bytes", T.LongType())])
    if name_col is None:
        own = [c for c in ("img_path", "path") if c in images.columns]
        name = F.regexp_replace(P.stem(own[0]), r"^([a-z0-9]+:)?/+", "") if own else F.col("image_id")
        if "variant" in images.columns and own:
            name = F.concat(name, F.coalesce("variant", F.lit("")))
        images, name_col = images.withColumn("_file_name", name), "_file_name"
    opened: dict = {}

    def fn(row):
        if "fs" not in opened:  # once per task
            opened["fs"], opened["base"], _ = _open(folder)
        filesystem = opened["fs"]
        img = decode(row.get("height"), row.get("width"), row.get("n_channels"), row.get("data"))
        payload = png_encode(img) if img is not None else bytes(row.get("data") or b"")
        target = f"{opened['base'].rstrip('/')}/{row[name_col]}{ext}"
        parent = target.rpartition("/")[0]
        if parent not in opened:
            filesystem.create_dir(parent, recursive=True)
            opened[parent] = True
        # a retried or speculative task writes a private file, then renames it
        # over the target: readers never see a half-written image
        tmp = f"{target}.tmp-{uuid.uuid4().hex}"
        with filesystem.open_output_stream(tmp) as out:
            out.write(payload)
        filesystem.move(tmp, target)
        yield {"path": target, "n_bytes": len(payload)}

    return map_rows(images, fn, schema, batch_rows=256)


def pillow_decoder(data: bytes):
    """Decode file bytes with Pillow (if installed on the executors) into a
    BGR (h, w, 3) uint8 array -- the layout of Spark's image source."""
    import io

    import numpy as np
    from PIL import Image  # optional dependency, imported on the executor

    with Image.open(io.BytesIO(data)) as im:
        rgb = np.asarray(im.convert("RGB"), dtype=np.uint8)
    return np.ascontiguousarray(rgb[:, :, ::-1])


def opencv_decoder(data: bytes):
    """Decode file bytes with OpenCV (if installed on the executors): BGR,
    three channels, EXIF ignored -- the reference's own image read."""
    import cv2
    import numpy as np

    flags = cv2.IMREAD_COLOR | cv2.IMREAD_IGNORE_ORIENTATION
    return cv2.imdecode(np.frombuffer(data, dtype=np.uint8), flags)


def installed_decoder():
    """``opencv_decoder`` or ``pillow_decoder``, whichever is installed; else None."""
    import importlib.util
    if importlib.util.find_spec("cv2"):
        return opencv_decoder
    return pillow_decoder if importlib.util.find_spec("PIL") else None


def deal_by_bytes(files: DataFrame, tasks: int, path_col: str = "path", length_col: str = "length") -> DataFrame:
    """The rows of ``files`` (distinct paths) in ``tasks`` partitions of about equal bytes.

    Paths fall into ``_FINE`` hash buckets a task; running sums of the buckets'
    bytes, a table of tasks x ``_FINE`` rows whatever the input, name each bucket's
    task.  A null length counts as 0, and every file as ``_OPEN_COST`` bytes more."""
    n = tasks * _FINE
    rows = files.withColumn("_bucket", F.pmod(F.xxhash64(path_col), F.lit(n)).cast("int"))
    sums = rows.groupBy("_bucket").agg(F.sum(F.coalesce(length_col, F.lit(0)) + _OPEN_COST).alias("_bytes"))
    upto = F.sum("_bytes").over(Window.orderBy("_bucket")) - F.col("_bytes") / 2
    total = F.sum("_bytes").over(Window.partitionBy(F.lit(0)))
    dealt = sums.select("_bucket", F.least(F.floor(upto * tasks / total), F.lit(tasks - 1)).cast("int").alias("_task"))
    out = rows.join(F.broadcast(dealt), "_bucket")  # at most tasks x _FINE rows
    return out.repartitionById(tasks, "_task").select(*files.columns)


def decode_paths(paths: DataFrame, decoder, path_col: str = "img_path",
                 partitions: int | None = None, length_col: str = "length") -> DataFrame:
    """Read and decode only the listed files, on the executors.

    ``paths`` holds one row per wanted file (deduplicate first).  With a column of
    lengths the files are dealt to ``partitions`` tasks (default: shuffle partitions)
    by their bytes (``deal_by_bytes``), else by hash; each task reads its files'
    bytes (``pyarrow.fs``: local, HDFS, S3) and calls ``decoder(bytes) -> BGR
    array``.  Nothing but paths is shuffled, the driver holds no file index, and
    files outside ``paths`` are never opened -- unlike a decode scan of the whole
    folder followed by a join.  Names starting with '_' or '.' are files like
    others.  Undecodable and empty files get height -1 and empty data, like Spark's
    image source; missing files give no row (the row that points at one is SKIPPED).
    """
    from specimen.functions.codec import encode, map_rows, three_channels

    schema = T.StructType([T.StructField(path_col, T.StringType()),
                           *[f for f in IMAGE_FIELDS if f.name != "image_id"]])
    n = partitions or int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if length_col in paths.columns:
        spread = deal_by_bytes(paths.select(path_col, length_col), n, path_col, length_col).select(path_col)
    else:
        spread = paths.select(path_col).repartition(n, path_col)

    opened: dict = {}  # scheme and host -> (file system, prefix), once per task

    def read_bytes(path: str) -> bytes:
        path = local_path_str(path)
        host = "/".join(path.split("/")[:3]) if "://" in path else ""
        if host not in opened:
            filesystem, _, prefix = _open(path)
            opened[host] = filesystem, len(prefix)
        filesystem, cut = opened[host]
        with filesystem.open_input_stream(path[cut:]) as f:
            return f.read()

    def fn(row):
        path = row[path_col]
        try:
            data = read_bytes(path)
        except FileNotFoundError:
            return  # no row: a missing file is SKIPPED downstream, as in the decode scan
        try:
            img = three_channels(decoder(data)) if data else None
        except Exception:  # noqa: BLE001 -- an undecodable file is a row, not a job failure
            img = None
        if img is None:
            yield {path_col: path, "height": -1, "width": -1, "n_channels": -1, "data": b""}
        else:
            yield {path_col: path, **encode(img)}

    return map_rows(spread, fn, schema, batch_rows=16)


def read_image_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back: a stable intermediate that survives executor
    loss and is never recomputed (S10)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
