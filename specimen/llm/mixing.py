"""Mixing sources to target weights (operator 6, native).

A source's natural share is its share of all tokens (words); its mixing weight is
that share to the power alpha, normalised.  alpha is bisected in [0, 1]: with
``target_entropy`` (a share of the largest possible entropy) the largest alpha
that reaches it, with ``max_repeats`` the smallest alpha under which no source is
read more often; with both, the larger of the two.  Entropy and limit need only
sums over sources, evaluated for a grid of exponents in one aggregate per round,
so sources are never collected.

Without a budget the mix holds every document at least once: the source with
most tokens per weight is read exactly once.  A source with quota Q tokens and T
tokens of its own gets Q div T whole blocks, each a permutation of all its
documents, and the start of one more permutation up to Q mod T tokens.
Permutations are orders of md5(seed:block:doc_id:md5(text)), so rows without an id
or with a repeated one are dealt each by its text.

The cut of the last block is exact without sorting a source in one task: tokens
are summed by (source, first three hex digits), the running sums (4,096 rows a
source) name the one bucket that holds the cut, and only that bucket is ordered.
A source's cut is then one hash, and documents are compared with it: texts never
cross an exchange while the table of sources is broadcast by its size, and
otherwise adaptive execution splits a hot source.

Defined results: a null source counts as ''; null texts have no tokens; a source
without tokens is read once per document; rows equal in doc_id and text share a
hash and stay in or out together; an empty table gives an empty table; extra columns
are passed through by ``mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specimen.llm.common import documents, words, written

MAX_REPEATS, SEED, DIGITS = 2.0, "mix", 6
_GRID = 33


def _order(block: Column | int, seed: str) -> Column:
    block = F.lit(block) if isinstance(block, int) else block
    return F.md5(F.concat_ws(":", F.lit(seed), block.cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                             F.md5(F.coalesce(F.col("text"), F.lit("")))))


def _measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({"_mx_source": F.coalesce(F.col("source"), F.lit("")),
                             "_mx_tokens": F.size(words(text)).cast("long")})


def source_sizes(docs: DataFrame) -> DataFrame:
    return _measured(docs).groupBy(F.col("_mx_source").alias("source")).agg(
        F.sum("_mx_tokens").alias("tokens"), F.count("*").alias("n_docs"))


def _sums(sizes: DataFrame, grid: list[float], top: int) -> tuple[list[float], list[float]]:
    """Per exponent a: the sums over sources of t^a and t^a ln t, t scaled by the top."""
    t = F.col("tokens") / F.lit(float(top))
    row = sizes.filter("tokens > 0").agg(
        F.array(*[F.sum(F.pow(t, F.lit(a))) for a in grid]).alias("z"),
        F.array(*[F.sum(F.pow(t, F.lit(a)) * F.log(t)) for a in grid]).alias("l")).first()
    return row.z, row.l


def bisect_exponent(sizes: DataFrame, target_entropy: float | None = None,
                    max_repeats: float | None = MAX_REPEATS, budget: int | None = None) -> float:
    """The exponent, rounded up to six digits."""
    ends = sizes.filter("tokens > 0").agg(F.min("tokens").alias("lo"), F.max("tokens").alias("hi"),
                                          F.count("*").alias("n")).first()
    if not ends.n or ends.n == 1 or ends.lo == ends.hi:
        return 1.0
    low_t = ends.lo / ends.hi

    def search(fits) -> float:
        """The smallest exponent where ``fits`` (monotone) holds, or 1."""
        a, b = 0.0, 1.0
        while b - a > 10.0 ** -(DIGITS + 2):
            grid = [a + (b - a) * i / (_GRID - 1) for i in range(_GRID)]
            z, l = _sums(sizes, grid, ends.hi)
            good = [i for i in range(_GRID) if fits(grid[i], z[i], l[i])]
            if not good:
                return b
            if good[0] == 0:
                return a
            a, b = grid[good[0] - 1], grid[good[0]]
        return b

    alpha = 0.0
    if target_entropy is not None:  # entropy falls with the exponent
        most = math.log(ends.n)
        alpha = search(lambda a, z, l: math.log(z) - a * l / z < target_entropy * most)
    if max_repeats is not None:
        def limited(a: float, z: float, l: float) -> bool:
            if budget is None:
                return low_t ** (a - 1) <= max_repeats
            return budget / ends.hi * low_t ** (a - 1) / z <= max_repeats
        alpha = max(alpha, search(limited))
    return math.ceil(round(alpha * 10 ** DIGITS, 3)) / 10 ** DIGITS


def plan(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS,
         budget: int | None = None, seed: str = SEED) -> DataFrame:
    """One row per source: tokens, weight, quota, blocks (whole ones) and ``cut``,
    the largest hash of the started block (null: none of it)."""
    docs = docs.select("doc_id", "source", "text")
    measured = _measured(docs)
    sizes = written(source_sizes(docs), "source-sizes")
    alpha = bisect_exponent(sizes, target_entropy, max_repeats, budget)
    ends = sizes.agg(F.max("tokens")).first()[0] or 1
    z = (_sums(sizes, [alpha], ends)[0][0] or 1.0) if ends > 0 else 1.0
    t = F.col("tokens") / F.lit(float(max(ends, 1)))
    share = F.pow(t, F.lit(alpha)) / F.lit(z)
    quota = (F.round(F.pow(t, F.lit(alpha - 1)) * F.col("tokens")) if budget is None
             else F.round(share * F.lit(float(budget)))).cast("long")
    has = F.col("tokens") > 0
    quotas = sizes.select(
        "source", "tokens", F.when(has, share).otherwise(0.0).alias("weight"),
        F.when(has, quota).otherwise(0).cast("long").alias("quota")).withColumns({
            "blocks": F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1).cast("long")})
    quotas = quotas.withColumn("rest", F.when(has, F.col("quota") - F.col("blocks") * F.col("tokens")).otherwise(0))
    quotas = written(quotas, "quotas")
    # the hash at which each source's started block ends
    hashed = measured.join(quotas.select(F.col("source").alias("_mx_source"), "blocks", "rest"), "_mx_source").filter(
        "rest > 0").select("_mx_source", "rest", "_mx_tokens", _order(F.col("blocks") + 1, seed).alias("h"))
    sums = hashed.groupBy("_mx_source", F.left("h", F.lit(3)).alias("bucket")).agg(
        F.sum("_mx_tokens").alias("n"), F.max("rest").alias("rest"))
    run = Window.partitionBy("_mx_source").orderBy("bucket")
    sums = sums.withColumn("upto", F.sum("n").over(run))
    edge = sums.filter(F.col("upto") > F.col("rest")).groupBy("_mx_source").agg(
        F.min("bucket").alias("bucket"), F.min(F.struct("bucket", F.col("upto") - F.col("n")))["col2"].alias("before"))
    edge = written(edge, "edges")
    inside = hashed.withColumn("bucket", F.left("h", F.lit(3))).join(edge, ["_mx_source", "bucket"])
    order = Window.partitionBy("_mx_source", "bucket").orderBy("h")  # ties share a running sum
    cut = (inside.withColumn("upto", F.sum("_mx_tokens").over(order) + F.col("before"))
           .filter(F.col("upto") <= F.col("rest")).groupBy(F.col("_mx_source").alias("source"))
           .agg(F.max("h").alias("_in")))
    return (quotas.join(edge.select(F.col("_mx_source").alias("source"), "bucket"), "source", "left")
            .join(cut, "source", "left")
            .select("source", "tokens", "weight", "quota", "blocks",
                    # inside the edge bucket the last hash that fits, else all hashes before the bucket
                    F.when(F.col("rest") > 0, F.coalesce("_in", "bucket")).alias("cut")))


def mix(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS,
        budget: int | None = None, seed: str = SEED) -> DataFrame:
    """``docs`` with ``_mx_block`` (from 1): one row per reading of a document."""
    table = written(plan(docs, target_entropy, max_repeats, budget, seed), "mix-plan")
    rows = _measured(docs).join(table.select(
        F.col("source").alias("_mx_source"), F.col("weight").alias("_mx_weight"),
        F.col("blocks").alias("_mx_blocks"), F.col("cut").alias("_mx_cut")), "_mx_source")
    more = F.coalesce(_order(F.col("_mx_blocks") + 1, seed) <= F.col("_mx_cut"), F.lit(False))
    n = F.col("_mx_blocks") + more.cast("long")
    return rows.withColumn("_mx_n", n).filter("_mx_n > 0").withColumn(
        "_mx_block", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mx_n"))))


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """``docs`` mixed: the same columns, documents repeated as their source is."""
    return mix(docs, **how).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return out.select("doc_id", F.col("_mx_source").alias("source"), F.col("_mx_tokens").alias("n_tokens"),
                      F.round("_mx_weight", 9).alias("weight"), F.col("_mx_block").alias("block"),
                      _order(F.col("_mx_block"), SEED).alias("block_order"))


OP6_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source,
        coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) AS doc_key,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
s AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS t FROM d GROUP BY source),
e AS (SELECT max(t) AS hi, min(t) FILTER (t > 0) AS lo FROM s),
a AS (SELECT CASE WHEN lo = hi THEN 1.0 ELSE ceil(round(greatest(0.0, 1 - ln({MAX_REPEATS}) / ln(hi / lo)) * 1000000, 3))
        / 1000000 END AS alpha, hi FROM e),
z AS (SELECT sum(pow(t / hi, alpha)) AS z FROM s, a WHERE t > 0),
q AS (SELECT source, t, CASE WHEN t > 0 THEN pow(t / hi, alpha) / z ELSE 0 END AS weight,
        CASE WHEN t > 0 THEN CAST(round(pow(t / hi, alpha - 1) * t) AS BIGINT) ELSE 0 END AS quota FROM s, a, z),
b AS (SELECT *, CASE WHEN t > 0 THEN quota // t ELSE 1 END AS blocks,
        CASE WHEN t > 0 THEN quota - (quota // t) * t ELSE 0 END AS rest FROM q),
o AS (SELECT d.*, round(b.weight, 9) AS weight, b.blocks, b.rest,
        sum(n_tokens) OVER (PARTITION BY d.source ORDER BY md5('{SEED}:' || (b.blocks + 1) || ':' || d.doc_key)) AS upto
      FROM d JOIN b ON d.source = b.source),
r AS (SELECT *, unnest(range(1, blocks + CASE WHEN rest > 0 AND upto <= rest THEN 2 ELSE 1 END)) AS block FROM o)
SELECT doc_id, source, n_tokens, weight, CAST(block AS BIGINT) AS block,
       md5('{SEED}:' || block || ':' || doc_key) AS block_order FROM r
"""
