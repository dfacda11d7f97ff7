"""Sums of doubles that do not depend on the order of their rows.

A double is a whole number of 53 bits times a power of two.  Values are dealt
into bins of six binary exponents; in a bin a value is a whole number below 2^62
times the bin's power of two, which is cut into three limbs of 21 bits.  Limbs
are summed as long integers: exactly, in any order, and for up to 2^42 rows of a
group and bin.  At the end the few bins of a group are added from the largest to
the smallest with the rounding errors carried along, always in the same order,
so that equal rows give bit-equal sums however they are partitioned, within one
unit in the last place of the exact sum.

The state of a sum is plain columns: a key (the bin) and sums, so states merge
by grouping on all keys and summing.  Infinite values and NaN are summed apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 6  # binary exponents of a bin
LIMB = 21  # bits of a limb
#: A value of bin b is a whole number of units of 2^(WIDTH * b - SHIFT); 2 bits more than its 53 need, as the
#: logarithm that finds the bin may be off by one at a power of two.
SHIFT = 54


def _pow2(n) -> Column:
    return F.pow(F.lit(2.0), n)


def _scaled(c: Column, n: Column) -> Column:
    """``c * 2^n`` in two steps, as 2^n alone may lie outside the doubles."""
    half = F.floor(n / F.lit(2))
    return c * _pow2(half) * _pow2(n - half)


def _finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def bin_of(c: Column) -> Column:
    """The bin of a double: null for null, the least for zero and what is not finite."""
    c = c.cast("double")
    exponent = F.floor(F.log2(F.abs(c)) / F.lit(WIDTH)).cast("int")
    return F.when(c.isNull(), F.lit(None).cast("int")).when((c == 0) | ~_finite(c), F.lit(-(1 << 20))).otherwise(exponent)


def limbs(c: Column) -> list[Column]:
    """Three limbs of a double in its bin, lowest first, and the value itself where it is not finite."""
    c = c.cast("double")
    plain = _finite(c) & (c != 0)
    whole = F.when(plain, _scaled(c, F.lit(SHIFT) - F.lit(WIDTH) * bin_of(c)).cast("long")) \
        .when(c.isNotNull(), F.lit(0).cast("long"))
    mask = F.lit((1 << LIMB) - 1).cast("long")
    return [whole.bitwiseAND(mask), F.shiftright(whole, LIMB).bitwiseAND(mask), F.shiftright(whole, 2 * LIMB),
            F.when(c.isNull(), F.lit(None).cast("double")).when(_finite(c), F.lit(0.0)).otherwise(c)]


def parts(bin_: str, sums: list[str]) -> Column:
    """A bin's sums as doubles that hold them exactly: an array of (rank, value), to be gathered per group."""
    mask = F.lit((1 << LIMB) - 1).cast("long")
    low, mid, high = (F.col(s) for s in sums[:3])
    mid = mid + F.shiftright(low, LIMB)  # carried up, so that a limb has 21 bits again
    high = high + F.shiftright(mid, LIMB)
    digits = [low.bitwiseAND(mask), mid.bitwiseAND(mask), high.bitwiseAND(mask), F.shiftright(high, LIMB)]
    unit = F.lit(WIDTH) * F.col(bin_) - F.lit(SHIFT)
    return F.array(*[F.struct((unit + F.lit(LIMB * k)).alias("rank"), _scaled(d.cast("double"), unit + F.lit(LIMB * k))
                              .alias("value")) for k, d in enumerate(digits)])


def total(gathered: Column) -> Column:
    """The sum of gathered (rank, value): by rank, then value, largest first, with the errors of each step kept."""
    ordered = F.sort_array(F.filter(F.flatten(gathered), lambda p: p["value"] != 0), asc=False)

    def step(acc: Column, p: Column) -> Column:
        v, t = p["value"], acc["s"] + p["value"]
        lost = F.when(F.abs(acc["s"]) >= F.abs(v), (acc["s"] - t) + v).otherwise((v - t) + acc["s"])
        return F.struct(t.alias("s"), (acc["c"] + lost).alias("c"))

    return F.aggregate(ordered, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c")), step,
                       lambda a: F.when(F.abs(a["s"]) == F.lit(float("inf")), a["s"]).otherwise(a["s"] + a["c"]))
