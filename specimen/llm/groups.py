"""Links inside candidate groups, without the pairs of a group.

``link_groups`` takes candidate groups (two sets may link only if some group
holds both) and finds the classes that all links between their members make.  A
link is a Jaccard similarity of at least ``num / den`` of two sets, checked
exactly.

1. Every group elects a lead, the member with most mates over all groups, and
   its members are checked against it: first each against its best lead, then
   against its other leads where the classes still differ.  Groups with one lead
   become one group.
2. A group whose members are all of one class is done.  In any other, a member is
   described by its difference to the lead: what it adds and what it lacks.  Two
   members x, y link only if their differences have overlap
   (|Dx| + |Dy| - h) / 2, where h bounds how far linked sets may be apart, at most
   ``(den - num) / num`` of either's size.  Of two members in different classes one
   is not linked with the lead, so that overlap is positive, and by the prefix
   principle the first h + 1 elements of the longer difference and the first
   h / 2 + 1 of the shorter one meet, in any order common to the group: here the
   elements of fewest members first.  Members that meet in an element so are the
   next, smaller groups, and elect leads in turn.
3. A group with at most ``SMALL`` members outside its largest class is not split:
   these are compared with all members, as many pairs as members times a constant:
   sketches are compared far cheaper than the rows of a split are made.
   So is, for an end, what is left after ``SPLITS`` splits.

Before two sets are compared, their sizes and parity sketches are: linked sets of
x and y items differ in at most (x + y) (den - num) / (den + num), and sketches differ
in no more bits.  Most pairs end there: those of outsiders and members inside the
join that meets them, whose rows carry the sketches, so they are never written or sent.

Near copies of one text differ from it in words of their own, which stand first
in their differences: groups of thousands fall apart in one step, though every
pair that could link is kept.  A step costs as many rows as members times the
size of their differences.  Groups are tables throughout: hot groups are
aggregated partially, and joins have written tables on both sides, which adaptive
execution can split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specimen.llm.common import PARITY_BITS, drop_written, written
from specimen.llm.graph import components

SMALL, SPLITS, BITS = 512, 3, 24


def _only(sets: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """The sets that columns of a written table name, and few others: a table of at
    most 2 ** ``BITS`` bits with those of the ids set is broadcast, so however long
    the list is, sets that no row needs are not sent to the join that follows."""
    place = F.col("_id").bitwiseAND((1 << BITS) - 1)
    one = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    wanted = table.select(F.explode(F.array(*columns)).alias("_id")).select(place.alias("_place"))
    bits = wanted.groupBy(F.shiftright("_place", 6).alias("_at")).agg(F.bit_or(one).alias("_bits"))
    rows = sets.withColumn("_place", F.col("id").bitwiseAND((1 << BITS) - 1)).withColumn("_at", F.shiftright("_place", 6))
    return rows.join(F.broadcast(bits), "_at").filter(F.col("_bits").bitwiseAND(one) != 0).select(*sets.columns)


def checked(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``pairs`` (a, b) with ``linked``: whether the sets are similar enough."""
    sets = _only(sets, pairs, "a", "b")
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("_x")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("items").alias("_y")), "b")
    common = F.size(F.array_intersect("_x", "_y")).cast("long")
    union = F.size("_x") + F.size("_y") - common
    return both.select("a", "b", (den * common >= num * union).alias("linked"))


def near(p: Column | str, m: Column | str, q: Column | str, n: Column | str, num: int, den: int) -> Column:
    """Whether sets of sketches ``p``, ``q`` and sizes ``m``, ``n`` may be linked."""
    bits = [F.bit_count(F.get(p, F.lit(i)).bitwiseXOR(F.get(q, F.lit(i)))) for i in range(PARITY_BITS // 64)]
    m, n = F.col(m), F.col(n)
    return (den * F.least(m, n) >= num * F.greatest(m, n)) & (sum(bits[1:], bits[0]) * (den + num) <= (m + n) * (den - num))


def _sketches(sets: DataFrame) -> DataFrame:
    """(id, size, parity) and ``fine``, if there are any, of sets with items or with their ``size``."""
    size = F.col("size") if "size" in sets.columns else F.size("items")
    return sets.select("id", size.cast("long").alias("size"), *[c for c in ("parity", "fine") if c in sets.columns])


def apart(p: str, q: str) -> Column:
    """Bits in which two sketches differ; of two lengths, the longer is halved."""
    short = F.least(F.size(p), F.size(q))

    def halved(x: str) -> Column:
        both = F.zip_with(F.slice(x, F.lit(1), short), F.slice(x, short + 1, short), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(x) > short, both).otherwise(F.col(x))
    bits = F.zip_with(halved(p), halved(q), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.aggregate(bits, F.lit(0), lambda total, n: total + n)


def possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``pairs`` (a, b) with ``may``: whether sizes and sketches let the sets be linked;
    fine sketches are compared where a set has one."""
    sets = _sketches(sets)
    best = F.coalesce("fine", "parity") if "fine" in sets.columns else F.col("parity")

    def of(end: str, sketch: str, size: str) -> DataFrame:
        return sets.select(F.col("id").alias(end), best.alias(sketch), F.col("size").alias(size))
    both = pairs.join(of("a", "_p", "_m"), "a").join(of("b", "_q", "_n"), "b")
    coarse = (F.size("_p") == PARITY_BITS // 64) & (F.size("_q") == PARITY_BITS // 64)
    sized = den * F.least("_m", "_n") >= num * F.greatest("_m", "_n")  # so lengths differ by a factor of two at most
    fine = sized & (apart("_p", "_q") * (den + num) <= (F.col("_m") + F.col("_n")) * (den - num))
    return both.select("a", "b", F.when(coarse, near("_p", "_m", "_q", "_n", num, den)).when(sized, fine).otherwise(False).alias("may"))


def merge_classes(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (node, label) with the links (a, b) added; only classes that a new
    link touches are worked on, each standing for its nodes."""
    if labels is None:
        return components(links)
    def named(end: str) -> DataFrame:
        return labels.select(F.col("node").alias(end), F.col("label").alias(f"_{end}"))
    between = links.join(named("a"), "a", "left").join(named("b"), "b", "left").select(
        F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).filter("a <> b").distinct()
    between = written(between, "class-links")
    if between.isEmpty():
        return labels
    moved = components(between)
    old = labels.join(moved.select(F.col("node").alias("label"), F.col("label").alias("_to")), "label", "left").select(
        "node", F.coalesce("_to", "label").alias("label"))
    new = moved.join(labels.select("node"), "node", "left_anti")
    out = written(old.unionByName(new), "labels")
    drop_written(labels, moved, between)
    return out


def _class(rows: DataFrame, labels: DataFrame | None, name: str, out: str) -> DataFrame:
    if labels is None:
        return rows.withColumn(out, F.col(name))
    known = labels.select(F.col("node").alias(name), F.col("label").alias(out))
    return rows.join(known, name, "left").withColumn(out, F.coalesce(out, name))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("lead", "id").alias("a"), F.least("lead", "id").alias("b")).distinct()


def _differences(groups: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(key, g, id, must, most) of members of ``groups`` (g, lead, id, idx): one row per
    element of the difference to the lead; ``most`` is the bound h of the member."""
    sets = _only(sets, groups, "lead", "id")
    lead = sets.select(F.col("id").alias("lead"), F.col("items").alias("_x"))
    rows = groups.select("g", "lead", "id", F.col("idx").alias("must")).join(lead, "lead").join(
        sets.select("id", F.col("items").alias("_y")), "id")
    return rows.select("g", "id", "must", F.floor(F.size("_y") * (den - num) / num + 1e-6).cast("int").alias("most"), F.explode(
        F.concat(F.array_except("_y", "_x"), F.array_except("_x", "_y"))).alias("_item")).select(
            F.xxhash64("g", "_item").alias("key"), "g", "id", "must", "most")


def _prefixes(parts: DataFrame) -> DataFrame:
    """(key, g, id, must, idx): the rows of ``_differences`` that a member may meet
    others in; ``idx``: among its first h / 2 + 1."""
    held = written(parts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "held")
    rows = parts.join(held, "key", "left")
    order = Window.partitionBy("g", "id").orderBy(F.coalesce("n", F.lit(1)), "key")
    rows = rows.withColumn("_at", F.row_number().over(order)).filter(F.col("n").isNotNull() & (F.col("_at") <= F.col("most") + 1))
    return rows.select("key", "g", "id", "must", (F.col("_at") <= F.floor(F.col("most") / 2) + 1).alias("idx"))


def _open(rows: DataFrame, by: str, more: list[Column]) -> DataFrame:
    """Groups of ``rows`` (``by``, id, _c, idx, must) that may hold a link across
    classes: ``_top``, the largest class, ``_out``, how many members are outside it."""
    classes = rows.groupBy(by, "_c").agg(F.count("*").alias("_n"), F.max("idx").alias("idx"), F.max("must").alias("must"), *more)
    return classes.groupBy(by).agg(
        F.max_by("_c", F.struct("_n", "_c")).alias("_top"), (F.sum("_n") - F.max("_n")).alias("_out"),
        F.max("idx").alias("idx"), F.max("must").alias("must"),
        *[F.max(c).alias(c) for c in classes.columns if c == "_lead"]).filter("_out > 0 and idx and must").drop("idx", "must")


def _outside(rows: DataFrame, found: DataFrame, by: str, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(lead, id): members outside the largest class of their group with members of
    other classes, as roles, sizes and sketches allow.  Both sides of the join that
    meets them are read from a table, so a hot group can be split."""
    rows = rows.select(by, "id", "_c", "idx", "must").join(found.select(by, "_top"), by)
    held = written(rows.join(_sketches(sets).select("id", "parity", "size"), "id"), "compared")
    one = held.filter(F.col("_c") != F.col("_top")).select(
        by, F.col("id").alias("lead"), F.col("_c").alias("_d"), F.col("idx").alias("_idx"), F.col("must").alias("_must"),
        F.col("parity").alias("_parity"), F.col("size").alias("_size"))
    two = one.join(held, by).filter(
        (F.col("_c") != F.col("_d")) & (F.col("idx") | F.col("_idx")) & (F.col("must") | F.col("_must"))
        & near("parity", "size", "_parity", "_size", num, den))
    return two.select("lead", "id").distinct()


def _one_each(members: DataFrame) -> DataFrame:
    """(key, id, n) of one group of each list of members, told by two hashes of it; ``n`` is
    their number.  Near copies meet in dozens of groups of the same members."""
    groups = written(members.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("_x"), F.bit_xor(F.xxhash64(F.lit(7), "id")).alias("_y")), "lists")
    kept = written(groups.groupBy("n", "_x", "_y").agg(F.min("key").alias("key")).select("key", "n"), "group-sizes")
    rows = _only(members.select(F.col("key").alias("id"), F.col("id").alias("_member")), kept, "key")
    few = written(rows.select(F.col("id").alias("key"), F.col("_member").alias("id")).join(kept, "key"), "groups")
    drop_written(groups, kept)
    return few


def link_groups(members: DataFrame, sets: DataFrame, num: int, den: int,
                items: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame | None:
    """Labels (node, label) of the classes that links inside the groups make; nodes
    without a link may be missing, None stands for no link at all.

    ``members``: distinct (key, id) of groups of two or more; ``sets``: (id, items,
    parity) with distinct items and their sketch, of every member, and ``fine`` sketches
    if there are any.  Both are written tables.  Where ``sets`` has no items but their
    number, ``size``, ``items`` gives a written table (id, items) of the sets named in a
    column ``id``, and maybe others: items are then made for the few sets that need them."""
    members = _one_each(members)
    mates = written(members.groupBy("id").agg(F.sum("n").alias("mates")), "mates")
    leads = written(members.join(mates, "id").groupBy("key").agg(
        F.max(F.struct("mates", F.bitwise_not("id").alias("flip"))).alias("_top")).select(
            "key", F.bitwise_not("_top.flip").alias("lead"), F.col("_top.mates").alias("mates")), "leads")
    stars = written(members.join(leads, "key").filter(F.col("id") != F.col("lead")).select(
        "lead", "id", "mates").distinct(), "stars")
    drop_written(members, mates, leads)
    best = stars.groupBy("id").agg(F.max(F.struct("mates", F.bitwise_not("lead").alias("flip"))).alias("_top")).select(
        "id", F.bitwise_not("_top.flip").alias("lead"))

    def of(table: DataFrame, *columns: str) -> DataFrame:
        return items(table.select(F.explode(F.array(*columns)).alias("id"))) if items else sets

    def judged(table: DataFrame, full: DataFrame) -> DataFrame:
        close = checked(table.filter("may").select("a", "b"), full, num, den)
        out = written(close.unionByName(table.filter("not may").select("a", "b", F.lit(False).alias("linked"))), "tested")
        drop_written(table)
        return out

    def check(pairs: DataFrame) -> DataFrame:
        table = written(possible(pairs, sets, num, den), "pairs")
        full = of(table.filter("may"), "a", "b")
        out = judged(table, full)
        drop_written(full if items else None)
        return out

    # sketches and items of both rounds at once
    ahead = written(possible(_ordered(stars), sets, num, den), "star-pairs")
    full = of(ahead.filter("may"), "a", "b")

    def check_star(pairs: DataFrame) -> DataFrame:
        return judged(written(ahead.join(pairs, ["a", "b"], "left_semi"), "pairs"), full)

    tested = check_star(_ordered(best))
    labels = _merged(None, tested)

    def across(pairs: DataFrame) -> DataFrame:
        """Untested pairs (lead, id) between classes."""
        new = _ordered(pairs).join(tested.select("a", "b"), ["a", "b"], "left_anti")
        return _class(_class(new, labels, "a", "_ca"), labels, "b", "_cb").filter("_ca <> _cb").select("a", "b")

    new = check_star(across(stars))
    labels, tested = _merged(labels, new), tested.unionByName(new)
    drop_written(ahead, full if items else None)
    groups = stars.select(F.col("lead").alias("g"), "lead", "id", F.lit(True).alias("idx"), F.lit(True).alias("must"))
    # a lead that both roles allow decides most pairs; of those the least id
    first = F.max(F.struct((F.col("idx") & F.col("must")).alias("both"), "idx", F.bitwise_not("id").alias("flip"))).alias("_lead")
    step = 0
    while True:
        rows = written(_class(groups, labels, "id", "_c"), "rows")
        found = written(_open(rows, "g", []), "open-groups")
        if found.isEmpty():
            return labels
        small = F.lit(True) if step == SPLITS else F.col("_out") <= SMALL
        pairs = _outside(rows, found.filter(small), "g", sets, num, den)
        if step == SPLITS:
            return _merged(labels, check(across(pairs)))
        split = written(rows.join(found.filter(~small).select("g"), "g"), "split")
        full = of(split, "lead", "id")
        parts = written(_differences(split, full, num, den), "parts")
        drop_written(full if items else None)
        meeting = written(_class(_prefixes(parts), labels, "id", "_c"), "meeting")
        heads = written(_open(meeting, "key", [first]), "heads")
        pairs = pairs.union(_outside(meeting, heads.filter(small), "key", sets, num, den))
        parted = meeting.join(heads.filter(~small).select("key", F.bitwise_not("_lead.flip").alias("lead")), "key").filter(
            F.col("id") != F.col("lead")).groupBy(
            F.xxhash64("g", "lead").alias("g"), "lead", "id").agg(F.max("idx").alias("idx"), F.max("must").alias("must"))
        parted = written(parted, "groups")
        new = check(across(pairs.union(parted.select("lead", "id"))))
        drop_written(rows, found, split, parts, meeting, heads, groups)
        labels, tested, groups = _merged(labels, new), tested.unionByName(new), parted
        step += 1


def _merged(labels: DataFrame | None, tested: DataFrame) -> DataFrame | None:
    links = tested.filter("linked").select("a", "b")
    return labels if links.isEmpty() else merge_classes(labels, links)
