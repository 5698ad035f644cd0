"""Quality rules (operator 4, native).

Word unigrams and bigrams are hashed into ``BUCKETS`` buckets.  Two multinomials
are counted over all documents: the trusted target (documents labelled quality 1)
and the raw corpus (all documents).  A bucket's weight is the log ratio of its
smoothed target and raw probabilities in thousandths (a whole number, so sums do
not depend on task order).  A document's score is the mean weight of its n-grams,
and one threshold, ``SPREAD`` standard deviations under the mean of the trusted
documents' scores, decides every document that the base rules do not fail.

Everything is DataFrame functions.  The counts reach the exchange as at most
``BUCKETS`` rows a task; the weight table has exactly ``BUCKETS`` entries and is
a constant of the scoring pass, so scoring is a projection without a shuffle.
The trusted ids are joined by id: one exchange of (id, text), a little more than
the input.

Defined results: null text = empty, no words, base_failed; a null doc_id is
joined to no label; several label rows of an id count as trusted if any is 1;
without trusted documents the threshold is minus infinity and only the base
rules decide; rows that repeat an id are judged each on its own; extra columns
are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specimen.llm.common import WS_CHARS, documents, words, written

BUCKETS, SPREAD, UNIT = 1 << 14, 4.0, 1000
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = r"[#*$%&|<>]"


def _with_hashes(docs: DataFrame) -> DataFrame:
    """Adds ``_q_words`` and the hashes of words and of word pairs.

    Every array that a lambda indexes is a column of its own (and is used more
    than once, so the optimizer does not inline it into the lambda)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumn("_q_words", words(text))
    out = out.withColumn("_q_h1", F.transform("_q_words", lambda w: F.xxhash64(w)))
    return out.withColumn("_q_h2", _paired("_q_h1", 1))


def _paired(name: str, step: int) -> Column:
    """Hash of each element with the one ``step`` further on (shorter by ``step``)."""
    a = F.col(name)
    return F.when(F.size(a) <= step, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.slice(a, 1, F.greatest(F.size(a) - step, F.lit(0))),
                    lambda x, i: F.xxhash64(x, F.get(F.col(name), i + step))))


def _grams(buckets: int) -> Column:
    return F.transform(F.concat("_q_h1", "_q_h2"), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def base_metrics(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_q_*`` columns of the base rules; window of eight words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = _with_hashes(docs).withColumn("_q_h4", _paired("_q_h2", 2)).withColumn("_q_h8", _paired("_q_h4", 4))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WS_CHARS)) != "")
    out = out.withColumns({
        "_q_n": F.size("_q_words").cast("long"),
        "_q_chars": F.length(F.array_join("_q_words", "")).cast("long"),
        "_q_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "_q_lines": lines,
        # windows sorted by hash, only where one occurs twice
        "_q_sorted": F.when(F.size(F.array_distinct("_q_h8")) < F.size("_q_h8"), F.sort_array(
            F.transform("_q_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))})
    out = out.withColumn("_q_dup", (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"))
    near = lambda i: F.get(F.col("_q_sorted"), i)["h"]
    # (position, whether a neighbour has the same hash)
    out = out.withColumn("_q_again", F.when(F.size("_q_sorted") > 0, F.transform("_q_sorted", lambda x, i: F.when(
        F.coalesce(near(i - 1) == x["h"], F.lit(False)) | F.coalesce(near(i + 1) == x["h"], F.lit(False)), x["i"]))))
    at = F.sort_array(F.filter("_q_again", lambda i: i.isNotNull()))
    covered = F.aggregate(
        at, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
        lambda a: a["n"])
    return out.withColumn("_q_repeat", F.coalesce(covered, F.lit(0)).cast("long"))


def gram_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, target): n-grams of all rows and of the trusted ids' rows."""
    def counted(rows: DataFrame, name: str) -> DataFrame:
        grams = _with_hashes(rows.select("doc_id", "text")).select(F.explode(_grams(buckets)).alias("bucket"))
        return grams.groupBy("bucket").agg(F.count("*").alias(name))

    # merge: the trusted ids grow with the input, so the join has one form at every size
    target = docs.select("doc_id", "text").join(trusted.hint("merge"), "doc_id", "left_semi")
    return counted(docs, "raw").join(counted(target, "target"), "bucket", "left").select(
        "bucket", "raw", F.coalesce("target", F.lit(0)).alias("target"))


def weights(counts: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Log ratios in thousandths, add-one smoothed; ``buckets`` numbers."""
    raw, target = [0] * buckets, [0] * buckets
    for r in counts.collect():  # at most ``buckets`` rows
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    n_raw, n_target = sum(raw) + buckets, sum(target) + buckets
    return [round(UNIT * (math.log((t + 1) / n_target) - math.log((r + 1) / n_raw))) for r, t in zip(raw, target)]


def scored(docs: DataFrame, table: list[int]) -> DataFrame:
    """Base metrics and ``_q_score``, the mean weight of the n-grams."""
    lookup = F.expr("cast(split('" + ",".join(map(str, table)) + "', ',') as array<int>)")
    out = base_metrics(docs).withColumn("_q_grams", _grams(len(table)))
    total = F.aggregate("_q_grams", F.lit(0).cast("long"), lambda a, g: a + F.get(lookup, g))
    return out.withColumn("_q_score", F.when(F.size("_q_grams") > 0, total / F.size("_q_grams")))


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, spread: float = SPREAD) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, score) of every row."""
    trusted = labels.filter(F.col("quality") == 1).select("doc_id").distinct()
    table = weights(gram_counts(docs, trusted, buckets), buckets)
    rows = scored(docs.select("doc_id", "text"), table).select(
        "doc_id", F.col("_q_n").alias("n_words"), F.col("_q_chars").alias("word_chars"),
        F.col("_q_symbols").alias("n_symbols"), F.col("_q_dup").alias("n_dup_lines"),
        F.col("_q_repeat").alias("n_repeat_words"), F.col("_q_score").alias("score"))
    rows = written(rows, "quality-scores")
    s = F.round("score").cast("decimal(20,0)")
    stats = rows.filter("score is not null").join(trusted, "doc_id", "left_semi").agg(
        F.count("*").alias("n"), F.sum(s).alias("s"), F.sum(s * s).alias("q")).first()
    floor = -math.inf
    if stats.n:
        mean = float(stats.s) / stats.n
        floor = mean - spread * math.sqrt(max(float(stats.q) / stats.n - mean * mean, 0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(0.0)) >= F.lit(floor)))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "score")
