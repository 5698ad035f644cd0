"""PII (operator 7, native): bootstrapped contextual extraction.

Base kinds (email, ip, card, phone) are found by patterns in every whole text;
positions come from the lengths of the pieces between matches.  Identifier-like
tokens (at least ``MIN_CHARS`` characters and three digits) that no base span
overlaps are candidates.  Every base span and candidate is an instance with
lexical patterns: the word before its token (``L``), the word after (``R``), and
the lead-in of its token up to '=' or ':' (``P``, as in ``key=...``; also an ``L``).
A word that ends in '=' or ':' or stands before a lone one is a key, written
``key=`` in every pattern, so that ``key=...``, ``key = "..."`` and ``"key": "..."``
meet.  Contexts are taken from the whole text; in a list of matches of one kind
with nothing between, all have the words around the list.

Bootstrapping: the base spans are the seed entities, one type a kind, with
confidence 1; so are opaque strings (``OPAQUE_CHARS`` or more letters, digits, '-'
and '_', six letters among them), a fifth type whose patterns are keys only: no
opaque string is a span by its form.  Candidates of the form of a base kind that
failed its rule (a number of 13 to 19 digits, four dotted numbers, a phone) or that
are part of a number over several words are rejected: never believed, but counted.

In each of ``ROUNDS`` rounds Spark scores the pattern-instance graph: a pattern's
score is the confidence of its distinct instances of one type, the strongest, over
the number of all its distinct instances plus one (at least ``MIN_SEEDS`` distinct
instances of that type believed by then required), and a candidate instance's
confidence is the mean of its scored patterns, counted from ``FLOOR`` up: from there
it is believed, of its best pattern's type, so instances that confident patterns
raise support further patterns, one hop a round.  A candidate, not rejected, with a
pattern scoring ``TRUSTED`` or more is added as a span of kind ``context``.  Scores
are whole thousandths, so sums do not depend on task order.

One pass reads the texts and writes only found pieces; the graph works on those
rows.  Frequent contexts are first reduced to distinct (pattern, instance) edges,
patterns and instances are partial aggregates, and no pairs are formed.

Patterns use possessive runs and look-behinds, so a long run of characters costs
linear time; they match what the plain patterns match.

Defined results: null text = empty, no span; rows that repeat a doc_id and text
have equal spans, the ones with another text their own; a null doc_id is a
document of its own; an empty table gives an empty table; extra columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specimen.llm.common import documents, written

KINDS = ("email", "ip", "card", "phone")
ADDED = "context"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MIN_CHARS, MIN_SEEDS, ROUNDS, FLOOR, TRUSTED = 8, 3, 3, 500, 700
_CANDIDATE = (r"(?<![^\x20\x09-\x0D])(?=(?:[^0-9\x20\x09-\x0D]*+[0-9]){3})[^\x20\x09-\x0D]{%d,}+" % MIN_CHARS)
_EDGE = ".,;:!?\"'()[]{}<>|"
_LEAD_IN = r"(?<![^\x20\x09-\x0D])([^0-9\x20\x09-\x0D]*[=:])[.,;!?\"'()\[\]{}<>|]*+$"
_GLUED = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]++\z"
_QUOTES = r"(?<![^\x20\x09-\x0D])[.,;!?\"'()\[\]{}<>|]++\z"
#: up to three words before the end and what is glued to the end; from word starts only, so long texts cost linear time
_TAIL = r"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){0,3}+[^\x20\x09-\x0D]*+\z"
_KEY = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]++(?:=>|:=|[=:])[\x20\x09-\x0D]*+\z"
_LAST = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+\z"
_NEXT = r"\A[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)"
#: the forms of card, ip and phone: a free candidate of one of them failed the kind's rule
_FAILED = r"^(?:[0-9](?:-?[0-9]){12,18}|[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++|\+[0-9][().0-9-]+)$"
_OPAQUE = r"^(?=(?:[^A-Za-z]*+[A-Za-z]){6})[A-Za-z0-9_-]{%d,}+$"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_BLOCK = 256
OPAQUE_CHARS, OPAQUE, FREE, REJECTED = 20, 4, 8, 9  # types of instances; 0 to 3 are the base kinds
_NULL_ID = -(1 << 63)
_FOUND = "array<struct<kind:int,start:int,end:int,prev:string,next:string,lead:string,value:string>>"


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def _find(text: Column, kinds: list[str]) -> Column:
    """All matches of the patterns with positions and neighbouring words.

    Starts are prefix sums, taken in blocks of 256 so that a text with many
    matches stays near linear."""
    raw = []
    for k, pattern in enumerate(kinds):
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        raw.append(F.struct(F.lit(k).alias("kind"), hits.alias("hits")))
    # matches first; the text is cut only where there are some
    gaps = [F.when(F.size(F.get(F.col("_pi_hits"), k)["hits"]) > 0, F.split(text, p)) for k, p in enumerate(kinds)]
    return F.array(*raw), F.array(*[F.struct(F.lit(k).alias("kind"), F.get(F.col("_pi_hits"), k)["hits"].alias("hits"),
                                             g.alias("gaps")) for k, g in enumerate(gaps)])


def _spans(matched: Column) -> Column:
    steps = F.transform(matched, lambda m: F.struct(
        m["kind"].alias("kind"), m["hits"].alias("hits"), m["gaps"].alias("gaps"),
        F.transform(m["hits"], lambda h, i: F.length(F.get(m["gaps"], i)) + F.coalesce(
            F.length(F.get(m["hits"], i - 1)), F.lit(0))).alias("u")))
    blocked = F.transform(steps, lambda m: F.struct(
        m["kind"].alias("kind"), m["hits"].alias("hits"), m["gaps"].alias("gaps"),
        F.when(F.size(m["u"]) > 0, F.transform(
            F.sequence(F.lit(0), F.floor((F.size(m["u"]) - 1) / _BLOCK).cast("int")),
            lambda j: F.slice(m["u"], j * _BLOCK + 1, F.lit(_BLOCK)))).alias("blocks")))
    summed = F.transform(blocked, lambda m: F.struct(
        m["kind"].alias("kind"), m["hits"].alias("hits"), m["gaps"].alias("gaps"), m["blocks"].alias("blocks"),
        F.transform(m["blocks"], _total).alias("totals")))
    started = F.transform(summed, lambda m: F.struct(
        m["kind"].alias("kind"), m["hits"].alias("hits"), m["gaps"].alias("gaps"),
        F.flatten(F.transform(m["blocks"], lambda b, j: F.transform(b, lambda x, i: _total(
            F.slice(m["totals"], F.lit(1), j)) + _total(F.slice(b, F.lit(1), i + 1))))).alias("starts")))
    tailed = F.transform(started, lambda m: F.struct(
        m["kind"].alias("kind"), m["hits"].alias("hits"), m["gaps"].alias("gaps"), m["starts"].alias("starts"),
        F.transform(m["gaps"], lambda g: F.regexp_extract(g, _TAIL, 0)).alias("tails")))
    # what stands before a match in its token counts as a lead-in where it ends in '=' or ':', quotes and brackets aside
    lead = lambda tail: F.regexp_extract(tail, _LEAD_IN, 1)

    def word(tail: Column) -> Column:
        bare = F.regexp_replace(tail, F.when(lead(tail) != "", _GLUED).otherwise(_QUOTES), F.lit(""))
        key = F.regexp_extract(bare, _KEY, 1)
        return F.lower(F.when(key != "", F.concat(key, F.lit("="))).otherwise(F.regexp_extract(bare, _LAST, 1)))

    # null: nothing between this match and its neighbour of the kind
    blank = lambda gap: F.trim(F.translate(gap, "\t\n\x0b\x0c\r", "     ")) == ""
    return F.flatten(F.transform(tailed, lambda m: F.coalesce(F.transform(m["starts"], lambda s, i: F.struct(
        m["kind"].alias("kind"), s.alias("start"), (s + F.length(F.get(m["hits"], i))).alias("end"),
        F.when((i == 0) | ~blank(F.get(m["gaps"], i)), word(F.get(m["tails"], i))).alias("prev"),
        F.when((i == F.size(m["hits"]) - 1) | ~blank(F.get(m["gaps"], i + 1)), F.lower(
            F.regexp_extract(F.get(m["gaps"], i + 1), _NEXT, 1))).alias("next"),
        lead(F.get(m["tails"], i)).alias("lead"),
        F.get(m["hits"], i).alias("value"))), F.array().cast(_FOUND))))


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    def add(s: Column, i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return s + F.when(i % 2 == 0, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(x: Column) -> Column:
    digits = F.regexp_replace(x["value"], "[^0-9]", "")
    return (F.when(x["kind"] == 1, x["value"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
            .when(x["kind"] == 2, F.length(digits).between(13, 19) & F.when(
                F.length(digits).between(13, 19), _luhn(digits)).otherwise(False))
            .when(x["kind"] == 3, F.length(digits).between(9, 15)).otherwise(True))


def find_base(docs: DataFrame) -> DataFrame:
    """(id, row, found) of every row: valid base spans (kinds 0-3, in order) and
    candidate tokens (kind 4)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"),
                       F.xxhash64(text).alias("row"), text.alias("_pi_text"))
    hits, matched = _find(F.col("_pi_text"), [*(PATTERNS[k] for k in KINDS), _CANDIDATE])
    rows = rows.withColumn("_pi_hits", hits).withColumn("_pi_matched", matched)
    return rows.select("id", "row", F.filter(_spans(F.col("_pi_matched")), _valid).alias("found"))


def _as_key(word: Column) -> Column:
    """A word that ends in '=' or ':' as ``word=``, quotes and brackets aside."""
    bare = F.regexp_replace(F.lower(word), r"[\"'()\[\]{}<>|,;]", "")
    return F.when(bare.rlike("[^=:][=:]+$"), F.regexp_replace(bare, "[=:]+$", "=")).otherwise(F.lower(word))


def _occurrences(found: DataFrame) -> DataFrame:
    """Seeds and free candidates as rows, with instance, type and patterns."""
    rows = found.select("id", "row", F.explode("found").alias("x")).select("id", "row", "x.*").distinct()
    w = Window.partitionBy("id", "row").orderBy("start", "kind")
    alike = Window.partitionBy("id", "row", "kind").orderBy("start")
    rows = rows.withColumns({
        "prev": _as_key(F.last("prev", True).over(alike.rowsBetween(Window.unboundedPreceding, 0))),
        "next": F.first("next", True).over(alike.rowsBetween(0, Window.unboundedFollowing))})
    base = F.col("kind") < len(KINDS)
    rows = rows.withColumns({
        "_past": F.max(F.when(base, F.col("end"))).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "_ahead": F.min(F.when(base, F.col("start"))).over(w.rowsBetween(1, Window.unboundedFollowing))})
    free = base | ((F.coalesce("_past", F.lit(0)) <= F.col("start")) & (
        F.coalesce("_ahead", F.col("end")) >= F.col("end")))
    rows = rows.filter(free)
    lead_in = F.when(~base, F.regexp_extract("value", r"^([^0-9]*[=:])", 1)).otherwise(F.col("lead"))
    bare = F.ltrim(F.substr("value", F.length("_in") + 1), F.lit(_EDGE))
    rows = rows.withColumn("_in", lead_in)
    quote = F.regexp_extract(F.substr("value", F.length("_in") + 1), r"^[.,;:!?()\[\]{}<>|]*([\"'])", 1)
    # a candidate that begins with a quote ends at the next one
    inside = F.when(quote != "", F.split_part(bare, quote, F.lit(1))).otherwise(bare)
    rows = rows.withColumn("_core", F.when(base, F.col("value")).otherwise(F.rtrim(inside, F.lit(_EDGE))))
    cut = F.length("value") - F.length(F.ltrim(F.substr("value", F.length("_in") + 1), F.lit(_EDGE)))
    first = F.when(base, F.col("start")).otherwise(F.col("start") + cut)
    key = _as_key(F.col("_in"))
    patterns = F.array_distinct(F.filter(F.array(
        F.when(F.col("prev") != "", F.concat(F.lit("L "), "prev")),
        F.when(F.col("next") != "", F.concat(F.lit("R "), "next")),
        F.when(F.col("_in") != "", F.concat(F.lit("L "), key)),
        F.when(F.col("_in") != "", F.concat(F.lit("P "), key))), lambda p: p.isNotNull()))
    number = r"^[0-9-]+$"
    failed = F.col("_core").rlike(_FAILED) | (F.col("_core").rlike(number) & (
        F.col("prev").rlike(number) | F.col("next").rlike(number)))
    of = (F.when(base, F.col("kind")).when(failed, REJECTED)
          .when(F.col("_core").rlike(_OPAQUE % OPAQUE_CHARS), OPAQUE).otherwise(FREE))
    return rows.filter(F.length("_core") > 0).select(
        "id", "row", "kind", first.alias("start"), (first + F.length("_core")).cast("int").alias("end"),
        F.xxhash64(F.lower("_core")).alias("instance"), of.cast("int").alias("type"), patterns.alias("patterns"))


def score_patterns(occurrences: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, of, score) after the last round: the type a pattern speaks for and its
    score in thousandths.  ``occurrences`` has instance, type and patterns; an instance
    seen as several types is of the least."""
    edges = written(occurrences.select(F.explode("patterns").alias("pattern"), "instance", "type")
                    .groupBy("pattern", "instance").agg(F.min("type").alias("type")), "pattern-edges")
    seed = F.col("type") <= OPAQUE
    believed = edges.groupBy("instance").agg(F.min("type").alias("type")).select(
        "instance", F.col("type").alias("of"), F.when(seed, 1000).otherwise(0).cast("long").alias("conf"))
    scores = None
    for _ in range(rounds):
        believed = written(believed, "instances")
        by_type = edges.join(believed, "instance").groupBy("pattern", "of").agg(
            F.sum("conf").alias("_s"), F.count("*").alias("_n"), F.sum((F.col("conf") >= FLOOR).cast("int")).alias("_seeds"))
        best = by_type.groupBy("pattern").agg(F.sum("_n").alias("_n"), F.max(F.struct("_s", "_seeds", "of")).alias("_top"))
        scores = written(
            best.filter((F.col("_top._seeds") >= MIN_SEEDS) & ((F.col("_top.of") != OPAQUE) | F.col("pattern").endswith("=")))
            .select("pattern", F.col("_top.of").alias("of"),
                    F.floor(F.col("_top._s") / (F.col("_n") + 1)).cast("long").alias("score")), "patterns")
        mean = edges.join(scores, "pattern", "left").groupBy("instance").agg(
            F.min("type").alias("type"), F.max(F.struct("score", "of")).alias("_top"),
            F.floor(F.sum("score") / F.count("score")).cast("long").alias("_m"))  # of scored patterns; null without any
        believed = mean.select(
            "instance", F.when(seed, F.col("type")).otherwise(F.coalesce("_top.of", "type")).alias("of"),
            F.when(seed, 1000).when((F.col("type") == FREE) & (F.col("_m") >= FLOOR), F.col("_m"))
            .otherwise(0).cast("long").alias("conf"))
    return scores


def added_spans(found: DataFrame) -> DataFrame:
    """(id, row, added) of documents with spans that patterns discovered."""
    occurrences = written(_occurrences(found), "occurrences")
    trusted = score_patterns(occurrences).filter(F.col("score") >= TRUSTED).select("pattern")
    hits = occurrences.filter(F.col("type").isin(OPAQUE, FREE)).select(
        "id", "row", "start", "end", F.explode("patterns").alias("pattern")).join(trusted, "pattern", "left_semi")
    return hits.groupBy("id", "row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("added"))


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added) of every row; ``base`` has kind, start and end, ``added``
    start and end, in order."""
    found = written(find_base(docs), "found")
    out = found.join(added_spans(found), ["id", "row"], "left")
    return out.select(F.when(F.col("id") != _NULL_ID, F.col("id")).alias("doc_id"),
                      F.filter("found", lambda x: x["kind"] < len(KINDS)).alias("base"), "added")


def _listed(spans: Column, kind) -> Column:
    return F.transform(spans, lambda x: F.concat_ws(":", kind(x), x["start"].cast("string"), x["end"].cast("string")))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detect(documents(spark, sf_dir))
    names = F.array(*map(F.lit, KINDS))
    base = _listed(F.col("base"), lambda x: F.get(names, x["kind"]))
    more = F.coalesce(_listed(F.col("added"), lambda x: F.lit(ADDED)), F.array().cast("array<string>"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return rows.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                       F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                       F.array_join(F.concat(base, more), ",").alias("spans"),
                       F.size(more).cast("long").alias("n_context"))
