"""Membership in lists too long for a literal ``IN``: a bloom filter, then a semi join.

The filter is a bitmap in an array of long integers, made from the list by plain
aggregation and used as a scalar subquery.  It drops nearly all other rows where
they are scanned, before the semi join that decides shuffles anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bounded import local_table

#: Names up to which a list becomes a literal ``IN``, which the scan can use.
SHORT = 1000
#: Bits of the filter (1 MB) and hashes of a name: for a list of 10^6 names 2 % of other rows pass.
BITS, HASHES = 1 << 23, 4


def _places(c: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(c, F.lit(k)), F.lit(BITS)).cast("long") for k in range(HASHES)]


def bloom(names: DataFrame, column: str) -> DataFrame:
    """One row, ``bits``: the filter of a list of names, as BITS / 64 long integers whatever the list's length."""
    spark = names.sparkSession
    places = names.filter(F.col(column).isNotNull()).select(F.explode(F.array(*_places(F.col(column)))).alias("p"))
    word = places.groupBy(F.shiftright("p", 6).alias("w")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits"))
    all_words = spark.range(0, BITS // 64, 1, 4).withColumnRenamed("id", "w")
    return all_words.join(word, "w", "left").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))),
        lambda s: s["bits"]).alias("bits"))


def might_hold(c: Column, bits: Column) -> Column:
    """False where a name is surely not in the list (null: false)."""
    out = c.isNotNull()
    for p in _places(c):
        word = F.get(bits, F.shiftright(p, 6).cast("int"))
        out = out & (F.getbit(word, (p % 64).cast("int")) == 1)
    return out


def in_list(df: DataFrame, column: str, names: Sequence[str] | DataFrame, name: str | None = None) -> DataFrame:
    """Rows whose ``column`` is one of ``names``, given as a sequence or as a DataFrame with a column ``name``.

    A null is in no list.  Repeated names count once.
    """
    if not isinstance(names, DataFrame):
        wanted = [n for n in dict.fromkeys(names) if n is not None]
        if len(wanted) <= SHORT:
            return df.filter(F.col(column).isin(wanted)) if wanted else df.filter(F.lit(False))
        names, name = local_table(df.sparkSession, [(n,) for n in wanted], "name string"), "name"
    names = names.select(F.col(name or column).alias("__listed"))
    some = df.filter(might_hold(F.col(column), bloom(names, "__listed").scalar()))
    return some.join(names, some[column] == names["__listed"], "left_semi")
