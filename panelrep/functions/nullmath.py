"""Null/NaN/zero-division rules of the reporting workflow as native Column expressions.

Everything here returns a :class:`pyspark.sql.Column`; no Python runs per row.

* :func:`strict_sum` - a group sum that is null as soon as one input is null.
* :func:`ieee_div` - ``x / 0`` gives +Inf, -Inf or NaN instead of an error or null.
* :func:`if_else3` - a two-way choice whose null condition gives null.
* :func:`contains_or_false` - substring test where a null text counts as "no match".
* :func:`fill_missing` - replace null *and* NaN by a default, leave +-Inf alone.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_sum(c) -> Column:
    """Sum that is null when any input row of the group is null."""
    c = _col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def strict_sum_parts(c, prefix: str) -> list[Column]:
    """Partial state of a strict sum, for summing in two steps.

    Carries the sum and the number of non-null inputs; combined with a row
    count (:func:`row_count_part`) by :func:`strict_sum_merge`.
    """
    c = _col(c)
    return [F.sum(c).alias(f"{prefix}__s"), F.count(c).alias(f"{prefix}__n")]


ROWS = "__rows"


def row_count_part() -> Column:
    return F.count(F.lit(1)).alias(ROWS)


def strict_sum_merge(prefix: str) -> Column:
    """Final step of a strict sum over partial states (sum, non-null count, rows)."""
    return F.when(F.sum(f"{prefix}__n") == F.sum(ROWS), F.sum(f"{prefix}__s"))


def ieee_div(n, d) -> Column:
    """Double division with IEEE results on a zero divisor.

    ``1/0 = Inf``, ``-1/0 = -Inf``, ``0/0 = NaN``, ``NaN/0 = NaN``,
    ``null/0 = null``, ``x/null = null``.  Both sides are cast to double
    first, so decimal inputs divide like doubles.  (The sign of a negative
    zero divisor is not considered.)
    """
    n = _col(n).cast("double")
    d = _col(d).cast("double")
    at_zero = (F.when(n.isNull(), F.lit(None).cast("double"))
               .when((n == 0) | F.isnan(n), F.lit(float("nan")))
               .when(n > 0, F.lit(float("inf")))
               .otherwise(F.lit(float("-inf"))))
    return F.when(d == 0, at_zero).otherwise(n / d)


def if_else3(cond: Column, yes, no) -> Column:
    """``cond ? yes : no`` where a null condition gives null (not ``no``)."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def contains_or_false(c, text: str) -> Column:
    """Substring test where a null input is treated as no match."""
    return F.coalesce(_col(c).contains(text), F.lit(False))


def fill_missing(c, default=0) -> Column:
    """Replace null and NaN by ``default``; infinities stay."""
    c = _col(c)
    return F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(default)).otherwise(c)


def exact_lit(x) -> Column:
    """Literal for a conversion factor that keeps decimal arithmetic exact.

    Integers stay integers; floats become decimals written from their shortest
    repr, so ``decimal * factor`` stays decimal (exact) and
    ``double * factor`` is the same as multiplying by the float.
    """
    if isinstance(x, bool) or not isinstance(x, (int, float)):
        return F.lit(x)
    if isinstance(x, int):
        return F.lit(x)
    return F.lit(Decimal(repr(x)))
