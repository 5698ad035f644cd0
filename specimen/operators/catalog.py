"""Image listing and the lookups of metadata rows to image files.

The reference resolves every metadata row with a Python UDF probing six file
names on disk.  Here the listing is a DataFrame: each file is parsed once into
(image id, folder, extension), ranked by the reference's lookup order, and the
best file per image id is found with ``min_by`` (a partial aggregate, at most
six files per id).  Rows then get their path with one equi-join (J1); existence
tests are semi/anti joins (J2-J5).  Catalyst/AQE picks broadcast or
sort-merge from runtime sizes.  A join to the resolved catalog, an aggregate by id,
goes through ``cleaning.spread_join``, so that AQE's skew-join can split a hot id.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from specimen.functions import paths as P
from specimen.functions.scalar import half_sizes
from specimen.operators.cleaning import spread_join
from specimen.operators.ordinal import with_ordinal
from specimen.schema import EXTENSIONS, PART_DIRS


def part_dirs_under(root: str) -> list[str]:
    """The two image folders under a data root, in lookup order."""
    return [f"{root.rstrip('/')}/{d}" for d in PART_DIRS]


def parse_listing(listing: DataFrame, path_col: str = "path") -> DataFrame:
    """Add name, parent, stem, ext, image_id and variant suffix to a listing."""
    p = F.col(path_col)
    return listing.select(
        "*",
        P.basename(p).alias("name"),
        P.parent_dir(p).alias("parent"),
        P.extension(p).alias("ext"),
        P.name_stem(p).alias("image_id"),
        P.variant_suffix(p).alias("variant"),
    )


def image_listing(listing: DataFrame) -> DataFrame:
    """Files accepted as images by the case-insensitive rule, parsed."""
    return parse_listing(listing.filter(P.is_image_name("path")))


def resolve_catalog(listing: DataFrame, part_dirs: list[str]) -> DataFrame:
    """(image_id, img_path): the first existing candidate per id (J1 core).

    Priority = folder order then extension order ``.jpg .JPG .jpeg`` -- only
    files directly in a part folder with one of those exact extensions are
    candidates, as in the reference's lookup.
    """
    parsed = parse_listing(listing)
    dir_rank = F.lit(None).cast("int")
    for i, d in enumerate(part_dirs):
        dir_rank = F.when(F.col("parent") == d, F.lit(i)).otherwise(dir_rank)
    ext_rank = F.lit(None).cast("int")
    for i, e in enumerate(EXTENSIONS):
        ext_rank = F.when(F.col("ext") == e, F.lit(i)).otherwise(ext_rank)
    rank = dir_rank * len(EXTENSIONS) + ext_rank
    return (parsed.select("image_id", "path", rank.alias("_rank"))
            .filter(F.col("_rank").isNotNull())
            .groupBy("image_id")
            .agg(F.min_by("path", "_rank").alias("img_path")))


def with_img_path(meta: DataFrame, resolved: DataFrame) -> DataFrame:
    """Attach ``img_path`` (null when no file exists or the id is null)."""
    return spread_join(meta, resolved, "image_id", "left")


def candidate_table(meta: DataFrame, part_dirs: list[str]) -> DataFrame:
    """(image_id, pos, candidate): the six candidate paths per row."""
    return (meta.filter(F.col("image_id").isNotNull())
            .select("image_id", F.posexplode(P.candidate_paths("image_id", part_dirs))
                    .alias("pos", "candidate")))


def metadata_with_image(meta: DataFrame, resolved: DataFrame) -> DataFrame:
    """Rows whose image exists, as a semi join."""
    return spread_join(meta, resolved.select("image_id"), "image_id", "left_semi").select(*meta.columns)


def metadata_without_image(meta: DataFrame, resolved: DataFrame) -> DataFrame:
    """Rows with no image file."""
    return spread_join(meta, resolved.select("image_id"), "image_id", "left_anti").select(*meta.columns)


def original_images(listing: DataFrame, part_dirs: list[str]) -> DataFrame:
    """Image files in the part folders that are not derived variants."""
    return (image_listing(listing)
            .filter(F.col("parent").isin(*part_dirs) & F.col("variant").isNull()))


def images_without_label(listing: DataFrame, meta: DataFrame, part_dirs: list[str]) -> DataFrame:
    """Original image files with no labelled metadata row."""
    labelled = meta.filter(F.col("dx").isNotNull()).select("image_id")
    return (original_images(listing, part_dirs)
            .join(labelled, on="image_id", how="left_anti")
            .select("image_id", "path"))


def union_listings(listing: DataFrame) -> DataFrame:
    """Union of the three case-sensitive patterns, each file once."""
    wanted = F.lit(False)
    for e in EXTENSIONS:
        wanted = wanted | F.col("path").endswith(e)
    return listing.filter(wanted).select("path").distinct()


def union_parts(listing: DataFrame, part_dirs: list[str]) -> DataFrame:
    """Images per part folder over both folders, zero rows kept."""
    both = image_listing(listing).select(
        F.array_position(F.array(*map(F.lit, part_dirs)), F.col("parent")).cast("int").alias("part")).filter("part > 0")
    dims = listing.sparkSession.createDataFrame(
        [(i + 1, d) for i, d in enumerate(part_dirs)], "part int, part_dir string")
    counts = both.groupBy("part").agg(F.count(F.lit(1)).alias("n_images"))
    return (F.broadcast(dims).join(counts, on="part", how="left")
            .select("part", "part_dir", F.coalesce("n_images", F.lit(0)).cast("long").alias("n_images")))


def images_to_organize(listing: DataFrame, part_dirs: list[str]) -> DataFrame:
    """Images not yet inside a part folder; the parent folder is compared,
    not a string prefix, so ``part_10`` is not ``part_1`` (U3, M9)."""
    return union_listings(listing).filter(~P.parent_dir("path").isin(*part_dirs))


def kth_path(paths: DataFrame, k: int, small: int = 10_000, step: int = 2) -> str | None:
    """The ``k``-th smallest (from 1) of the distinct ``paths``, without sorting them.

    From the prefix that all share on, paths are counted by a prefix ``step``
    characters longer each round; running
    counts name the prefix that holds the k-th, and only its paths are counted
    further, until at most ``small`` are left to be ordered.  A round is one partial
    aggregate; its table has one row per prefix of ``step`` more characters."""
    rows = paths.select("path")
    ends = rows.agg(F.min("path").alias("low"), F.max("path").alias("high")).first()
    prefix = os.path.commonprefix([ends.low or "", ends.high or ""])
    while True:
        # a path that ends within the prefix is a group of its own: nothing longer equals it
        groups = rows.groupBy(F.left("path", F.lit(len(prefix) + step)).alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.max(F.length("path")).alias("long"))
        hit = (groups.withColumn("upto", F.sum("n").over(Window.orderBy("p")))
               .filter(F.col("upto") >= k).orderBy("p").limit(1).first())
        if hit is None:
            return None
        k -= hit.upto - hit.n
        if hit.n == 1 and hit.long <= len(prefix) + step:
            return hit.p
        prefix = hit.p
        rows = rows.filter(F.startswith("path", F.lit(prefix)))
        if hit.n <= small:
            return rows.orderBy("path").offset(k - 1).limit(1).first()[0]


def organize_parts(listing: DataFrame, part_dirs: list[str]) -> DataFrame:
    """First ceil(n/2) files in path order to part 1, the rest to part 2.

    Files are not moved: the result is the target folder per file.  The one path
    that ends the first half is selected (``kth_path``) and every file compared with
    it, so no row is sorted or ranked.
    """
    todo = images_to_organize(listing, part_dirs)
    n = todo.count()
    last = kth_path(todo, -(-n // 2)) if n else None
    part = F.when(F.col("path") <= F.lit(last), 1).otherwise(2)
    target = F.when(part == 1, F.lit(part_dirs[0])).otherwise(F.lit(part_dirs[1]))
    return todo.select(
        "path", part.cast("int").alias("part"),
        F.concat(target, F.lit("/"), P.basename("path")).alias("target_path"))


def locate_file_ci(listing: DataFrame) -> DataFrame:
    """For every file name, lower-cased: the first path (smallest) and how
    many files share it (S5)."""
    return (listing.groupBy(F.lower(P.basename("path")).alias("name_lower"))
            .agg(F.min("path").alias("first_path"), F.count(F.lit(1)).alias("n_matches")))


def locate_file(listing: DataFrame, name: str) -> DataFrame:
    """The first file (smallest path) whose lower-cased name equals ``name``
    lower-cased -- e.g. the metadata CSV under a data root (S5).  One row,
    or none when no file matches."""
    hits = listing.filter(P.lower_equals(P.basename("path"), F.lit(name)))
    return hits.agg(F.min("path").alias("path")).filter(F.col("path").isNotNull())


def dataset_ready(listing: DataFrame, meta: DataFrame, part_dirs: list[str]) -> DataFrame:
    """Metadata present and at least one image in part 1 or part 2.

    The image test is the reference's glob ``*.jp*g`` in each folder.
    """
    parent = P.parent_dir("path")
    glob = P.basename("path").rlike(r"^.*\.jp.*g$")
    meta_present = meta.exists()          # EXISTS subquery: stops at the first row
    counts = listing.agg(
        F.count_if((parent == part_dirs[0]) & glob).alias("part1_images"),
        F.count_if((parent == part_dirs[1]) & glob).alias("part2_images"))
    return counts.select(
        meta_present.alias("metadata_present"), "part1_images", "part2_images",
        (meta_present & ((F.col("part1_images") > 0) | (F.col("part2_images") > 0))).alias("ready"))


def split_two_nodes(rows: DataFrame, order_col: str = "img_path") -> DataFrame:
    """First floor(n/2) rows (in ``order_col`` order) to node 1, rest to node 2
    (I18, M17).  For real distribution use ``repartition(n, 'image_id')``."""
    ranked = with_ordinal(rows, [order_col], count_name="_n")
    _, first = half_sizes(F.col("_n"))
    return ranked.withColumn("node", F.when(F.col("ordinal") <= first, 1).otherwise(2).cast("int")) \
        .drop("_n")

