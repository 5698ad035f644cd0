"""Line dedup (operator 1, native).

Lines are exploded, normalised and hashed to 128 bits; hashes found in at least
``min_docs`` distinct documents are joined back, and every document drops its
lines with such a key unless it is the largest doc_id that holds the key.  What
stays is reassembled by position.

Only (id, position, hash) rows are exploded.  The distinct count is aggregated
by (hash, id) first, so a line held by a third of all documents is spread over
all tasks; the join back has unique keys on the other side, which is a written
table, so adaptive execution can split a hot hash.  Texts cross one exchange,
by id.

Defined results: a null text is the empty text, which is one empty line; a null
doc_id counts as one document with the smallest id; rows that repeat a doc_id
count as one document for the threshold and each is cleaned; an empty table
gives an empty table; other input columns are passed through by ``dedup_lines``
(the text replaced, ``n_chars`` renewed when present) and ignored by the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specimen.llm.common import ascii_lower, documents, hash128, trimmed, written

MIN_CHARS, MIN_DOCS = 20, 3
_NULL_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({
        "_ld_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)),
        "_ld_row": F.xxhash64(text), "_ld_text": text})


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(_ld_id, _ld_row, _ld_pos, _h1, _h2) of every line whose key is long enough."""
    lines = _keyed(docs).select("_ld_id", "_ld_row",
                                F.posexplode(F.split("_ld_text", "\n")).alias("_ld_pos", "_line"))
    keys = lines.withColumn("_line", trimmed(F.col("_line"))).filter(
        F.length("_line") >= min_chars).withColumn("_line", ascii_lower(F.col("_line")))
    return keys.select("_ld_id", "_ld_row", "_ld_pos", *hash128(F.col("_line")))


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS,
                   min_docs: int = MIN_DOCS) -> DataFrame:
    """(_h1, _h2, n_docs, keeper) of the keys found in at least ``min_docs`` documents."""
    return line_keys(docs, min_chars).groupBy("_h1", "_h2").agg(
        F.count_distinct("_ld_id").alias("n_docs"), F.max("_ld_id").alias("keeper"),
    ).filter(F.col("n_docs") >= min_docs)


def dedup_report(docs: DataFrame, min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of ``docs`` with ``_ld_lines``, ``_ld_drop`` (positions dropped,
    null if none) and ``_ld_kept`` (the text that stays)."""
    repeated = written(repeated_lines(docs, min_chars, min_docs), "repeated-lines")
    drop = (line_keys(docs, min_chars).join(repeated, ["_h1", "_h2"])
            .filter(F.col("_ld_id") != F.col("keeper"))
            .groupBy("_ld_id", "_ld_row").agg(F.collect_set("_ld_pos").alias("_ld_drop")))
    rows = _keyed(docs).join(drop, ["_ld_id", "_ld_row"], "left").withColumn(
        "_ld_lines", F.split("_ld_text", "\n"))
    # used twice, so the optimizer keeps it a column and the lambda does not split anew
    left = F.array_except(F.sequence(F.lit(0), F.size("_ld_lines") - 1), F.col("_ld_drop"))
    kept = F.when(F.col("_ld_drop").isNull(), F.col("_ld_text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col("_ld_lines"), i)), "\n"))
    return rows.withColumn("_ld_kept", kept)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text``; the same columns."""
    out = dedup_report(docs, min_chars, min_docs)
    renewed = {"text": F.col("_ld_kept"), "n_chars": F.length("_ld_kept").cast("long")}
    return out.select(*[renewed[c].alias(c) if c in renewed else F.col(f"`{c}`")
                        for c in docs.columns])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_report(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select(
        "doc_id", F.size("_ld_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_ld_drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2("_ld_kept", 256).alias("kept_sha256"))


_WS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
OP1_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, lines[i] AS line, i, translate(trim(lines[i], {_WS}),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
f AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20
      GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.doc_id, l.i, l.line, f.k IS NOT NULL AND l.doc_id <> f.keeper AS gone
      FROM l LEFT JOIN f ON l.k = f.k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
