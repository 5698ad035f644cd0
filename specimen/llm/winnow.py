"""Document fingerprints (operator 9, native): winnowing.

The tokens of a text are its words, lower-cased.  Every run of ``K`` words is
hashed, rolled up from word hashes by doubling; of every window of ``WINDOW``
such hashes the least is kept, of equal ones the rightmost, with its position.
Any passage of at least K + WINDOW - 1 = 19 words that two texts share leaves a
common fingerprint.  Texts with fewer than K words have one hash of all their
words; texts with fewer hashes than a window keep the least of them.

Likeness is the Jaccard similarity of the sets of kept hashes (1 for two empty
ones).  All steps are array functions on one row, linear in its words.

The next document (descending doc_id, the first after the last) comes from
positions over ids alone, numbered by range partitions; a document's text then
crosses one exchange by id, which serves both as its own side and as the side
whose front part goes to the previous id; only that half is sent on.

Defined results: null text = empty text: empty fingerprint; a null doc_id sorts
as the least id; rows that repeat a doc_id have one next document, that of the
next distinct id, and where that id repeats, its least front part; one single
document is its own next; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specimen.llm.common import documents, words, written
from specimen.operators.ordinal import with_ordinal

K, WINDOW = 4, 16
_NULL_ID = -(1 << 63)


def _doubled(df: DataFrame, src: str, dst: str, step: int) -> DataFrame:
    """dst[i] = hash of src[i], src[i + step] (shorter by ``step``)."""
    a = F.col(src)
    both = F.transform(F.slice(a, 1, F.greatest(F.size(a) - step, F.lit(0))),
                       lambda x, i: F.xxhash64(x, F.get(F.col(src), i + step)))
    return df.withColumn(dst, both)


def _least_ahead(src: str, step: int) -> Column:
    """The lesser of each value and the one ``step`` further on."""
    return F.transform(src, lambda x, i: F.least(x, F.get(F.col(src), i + step) - F.lit(step).cast("long")))


def fingerprints(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``_hashes and ``out``_at: kept hashes and their word positions.

    The four low bits of a value hold 15 minus the offset within the window, so
    the least value is the least hash and, of equals, the rightmost; ``least``
    skips the nulls beyond the end.  Arrays that a lambda indexes are columns
    used more than once, which the optimizer leaves as columns."""
    p = f"_{out}_"
    df = df.withColumn(p + "w", words(F.lower(F.coalesce(F.col(text), F.lit("")))))
    df = df.withColumn(p + "h1", F.transform(p + "w", lambda w: F.xxhash64(w)))
    df = _doubled(_doubled(df, p + "h1", p + "h2", 1), p + "h2", p + "h4", 2)
    short = F.when(F.size(p + "h1") == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(p + "h1")))
    df = df.withColumn(p + "g", F.when(F.size(p + "h1") < K, short).otherwise(F.col(p + "h4")))
    df = df.withColumn(p + "v1", F.transform(p + "g", lambda h: F.shiftleft(h, 4).bitwiseOR(F.lit(15).cast("long"))))
    for step in (1, 2, 4, 8):
        df = df.withColumn(f"{p}v{2 * step}", _least_ahead(f"{p}v{step}", step))
    kept = F.slice(p + "v16", 1, F.greatest(F.size(p + "v16") - (WINDOW - 1), F.least(F.size(p + "v16"), F.lit(1))))
    df = df.withColumn(f"{out}_at", F.array_distinct(F.transform(
        kept, lambda x, i: (i + F.lit(15) - x.bitwiseAND(F.lit(15).cast("long"))).cast("int"))))
    df = df.withColumn(f"{out}_hashes", F.transform(
        f"{out}_at", lambda i: F.shiftright(F.shiftleft(F.get(F.col(p + "g"), i), 4), 4)))
    return df.drop(*[p + s for s in ("w", "h1", "h2", "h4", "g", "v1", "v2", "v4", "v8", "v16")])


def as_text(name: str) -> Column:
    """'hash@position' joined by commas."""
    return F.array_join(F.zip_with(f"{name}_hashes", f"{name}_at", lambda h, i: F.concat(
        F.lower(F.hex(h)), F.lit("@"), i.cast("string"))), ",")


def likeness(a: str, b: str) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def next_ids(docs: DataFrame) -> DataFrame:
    """(id, next_id): the next smaller distinct id, the largest after the least."""
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id")).distinct()
    at = written(with_ordinal(ids, [F.desc("id")], name="at", count_name="n"), "id-order")
    after = at.select(F.col("id").alias("next_id"), F.col("at").alias("_at"))
    return at.withColumn("_at", F.col("at") % F.col("n") + 1).join(after, "_at").select("id", "next_id")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_chars, edited, next_hashes) of every row."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    need = rows.select("id", F.floor(F.length("text") / 2).cast("int").alias("need")).groupBy("id").agg(
        F.max("need").alias("need"))
    wanted = written(next_ids(docs).join(need, "id"), "next-ids")
    ahead = rows.withColumnRenamed("id", "next_id").join(wanted, "next_id")
    ahead = fingerprints(ahead, "text", "next").select(
        "id", F.struct(F.left("text", F.col("need")).alias("front"), F.col("next_hashes").alias("hashes")).alias("ahead"))
    # an aggregate lies by id already, so a join to it could not be split under a hot id: a written one can
    ahead = written(ahead.groupBy("id").agg(F.min("ahead").alias("ahead")), "next-texts")
    half = F.floor(F.length("text") / 2).cast("int")
    out = rows.join(ahead, "id").withColumn("n_chars", F.length("text").cast("long"))
    return out.select(
        F.when(F.col("id") != _NULL_ID, F.col("id")).alias("doc_id"), "text", "n_chars",
        F.concat(F.left("text", F.length("text") - half), F.left(F.col("ahead.front"), half)).alias("edited"),
        F.col("ahead.hashes").alias("next_hashes"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(documents(spark, sf_dir))
    rows = fingerprints(fingerprints(rows, "text", "own"), "edited", "changed")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text("own").alias("fingerprint"), as_text("changed").alias("edited_fingerprint"),
        likeness("own_hashes", "changed_hashes").alias("near_edited"),
        likeness("own_hashes", "next_hashes").alias("near_next"))
