"""Scalar column functions of the reports (JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from specimen.schema import MALIGNANT_CLASSES


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_label(c) -> Column:
    """Display value: null shown as 'NULL', anything else as text."""
    return F.coalesce(_c(c).cast("string"), F.lit("NULL"))


def percent_of_total(n, total) -> Column:
    """n / total * 100 as double, null when total is 0."""
    return (_c(n).cast("double") / F.nullif(_c(total).cast("double"), F.lit(0.0))) * 100.0


def format_percent(n, total) -> Column:
    """n / total * 100 with two decimals, rounded half to even on the exact
    fraction, using integer arithmetic only (X8)."""
    num = _c(n).cast("long") * 10000
    den = _c(total).cast("long")
    q = F.floor(num / den).cast("long")
    r = num - q * den
    up = F.when(2 * r > den, 1).when((2 * r == den) & (q % 2 == 1), 1).otherwise(0)
    cents = q + up
    txt = F.concat((cents / 100).cast("long").cast("string"), F.lit("."),
                   F.lpad((cents % 100).cast("string"), 2, "0"))
    return F.when(den > 0, txt)


def half_sizes(n) -> tuple[Column, Column]:
    """(ceil(n/2), n div 2) -- the organiser and the node split."""
    x = _c(n).cast("long")
    return ((x + 1) / 2).cast("long"), (x / 2).cast("long")


def int_trunc(x, ratio: float) -> Column:
    """int(x * ratio) for x >= 0."""
    return F.floor(_c(x).cast("double") * F.lit(float(ratio))).cast("int")


def clamp(x, lo, hi) -> Column:
    """min(max(x, lo), hi) (X11)."""
    lo_c = F.lit(lo) if not isinstance(lo, Column) else lo
    hi_c = F.lit(hi) if not isinstance(hi, Column) else hi
    return F.least(F.greatest(_c(x), lo_c), hi_c)


def binary_label(c, malignant: list[str] | None = None) -> Column:
    """'malignant' for the named classes, 'benign' otherwise, null stays null."""
    classes = MALIGNANT_CLASSES if malignant is None else malignant
    col = _c(c)
    return (F.when(col.isNull(), F.lit(None).cast("string"))
            .when(col.isin(*classes), "malignant").otherwise("benign"))


def upper_title(c) -> Column:
    """Upper-case heading text."""
    return F.upper(_c(c))
