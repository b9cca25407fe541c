"""Integer and decimal arithmetic with the truncating rules the reports depend on.

All helpers take and return ``Column`` and stay inside whole-stage codegen.
A zero or NULL divisor gives NULL, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def int_div(a, b) -> Column:
    """Integer quotient truncated toward zero (-7 / 2 = -3) as bigint; NULL for a zero divisor."""
    a, b = _col(a), _col(b)
    return F.when(b != 0, F.call_function("div", a, b))


def guarded_div(a, b) -> Column:
    """Like :func:`int_div`, but a zero divisor gives 0 (the "no activity, no cost" convention)."""
    a, b = _col(a), _col(b)
    return F.when(b == 0, F.lit(0).cast("bigint")).otherwise(int_div(a, b))


def int_avg(x) -> Column:
    """Mean of the non-null integers in a group, truncated to an integer (aggregate)."""
    x = _col(x)
    return int_div(F.sum(x), F.count(x))


def ratio_of_sums(a, b) -> Column:
    """``sum(a) div sum(b)``: the weighted mean or rate of a group (aggregate)."""
    return int_div(F.sum(_col(a)), F.sum(_col(b)))


def pct_trunc(part, total) -> Column:
    """``part`` as a percentage of ``total``: the ratio is cut at six digits, then rounded to two.

    12344996 of 100000000 is 12.34 here; dividing in full precision would give 12.35.
    """
    part = _col(part).cast("decimal(30,0)")
    total = _col(total).cast("decimal(30,0)")
    millionths = int_div(part * F.lit(1_000_000).cast("decimal(7,0)"), total)
    return F.round(millionths.cast("decimal(19,0)") / F.lit(10_000).cast("decimal(5,0)"), 2).cast("decimal(25,2)")


def ratio3(a, b) -> Column:
    """``a / b`` in decimal arithmetic, rounded half-up to three digits; NULL for a zero base."""
    a, b = _col(a).cast("decimal(18,0)"), _col(b).cast("decimal(18,0)")
    return F.round(F.try_divide(a, b), 3).cast("decimal(21,3)")


def trunc_int(x) -> Column:
    """Drop the fraction of a decimal or double (2.7 becomes 2, -2.7 becomes -2)."""
    return _col(x).cast("bigint")


# Units
def bytes_to_mb(x) -> Column:
    return int_div(x, 1024 * 1024)


def pages_to_kb(x) -> Column:
    return _col(x) * 8


def pages_to_mb(x) -> Column:
    return int_div(_col(x) * 8, 1024)


def micros_to_seconds(x) -> Column:
    return int_div(x, 1_000_000)


def micros_to_millis(x) -> Column:
    return int_div(x, 1_000)


def millis_to_seconds(x) -> Column:
    return int_div(x, 1_000)
