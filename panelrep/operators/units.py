"""Unit conversions as data: a graph of factors, composed along paths and joined to facts.

A factor table has rows (category, unit, to_unit, factor).  A category is a
sector, a gas or any other text; a null category is the default for those that
the table does not name.  Factors are decimals, so a path's product is exact.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bounded import Small, local_table, prove_bound

Row = tuple[str | None, str, str, Decimal]


def compose(rows: Iterable[Row], target: str) -> list[Row]:
    """Factors from every unit to ``target``, for every category: the product along the shortest path.

    A category uses its own factors and, where it has none for a pair of units,
    the default ones.  A factor given one way serves both ways if its inverse
    is a finite decimal of at most 17 places.  Units without a path are left out.
    """
    rows = [(c, a, b, Decimal(f)) for c, a, b, f in rows]
    out: list[Row] = []
    for category in dict.fromkeys([None, *[r[0] for r in rows]]):
        edges: dict[str, dict[str, Decimal]] = {}
        for c, a, b, f in [r for r in rows if r[0] is None] + [r for r in rows if r[0] == category and category is not None]:
            edges.setdefault(b, {})[a] = f  # walked from the target backwards
            inverse = None if f == 0 else 1 / f
            if inverse is not None and inverse * f == 1 and inverse == round(inverse, 17):
                edges.setdefault(a, {}).setdefault(b, inverse)
        found, todo = {target: Decimal(1)}, deque([target])
        while todo:
            at = todo.popleft()
            for unit, f in edges.get(at, {}).items():
                if unit not in found:
                    found[unit] = f * found[at]
                    todo.append(unit)
        out += [(category, unit, target, f) for unit, f in found.items()]
    return out


def factor_table(spark: SparkSession, rows: Iterable[Row], target: str) -> Small:
    """:func:`compose` as a lookup; the factors' type is as narrow as they allow, which keeps products exact."""
    paths = compose(rows, target)
    parts = [f.as_tuple() for *_, f in paths]
    scale = max([0, *(-p.exponent for p in parts)])
    whole = max([1, *(len(p.digits) + p.exponent for p in parts)])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("category", "unit", "to_unit")]
                          + [T.StructField("factor", T.DecimalType(whole + scale, scale))])
    return prove_bound(local_table(spark, paths, schema))


def label_categories(df: DataFrame, label: str, rules: Sequence[tuple[str, str]], default: str) -> DataFrame:
    """(label, category) of the distinct labels: the category of the first rule whose text a label holds, else ``default``."""
    c = F.lit(default)
    for text, category in reversed(rules):
        c = F.when(F.col(label).contains(text), category).otherwise(c)
    return df.select(label).distinct().withColumn("category", c)


def converted(df: DataFrame, value: str, unit: str, category: str, factors: Small) -> DataFrame:
    """``value`` times the factor of the row's category (the default's, where it has none) and unit.

    A row without a factor, or with a null category or unit, gets a null value.
    """
    f = factors.side()
    own = f.filter(F.col("category").isNotNull()).select(F.col("category").alias("__c"), F.col("unit").alias("__u"),
                                                         F.col("factor").alias("__own"))
    rest = f.filter(F.col("category").isNull()).select(F.col("unit").alias("__du"), F.col("factor").alias("__rest"))
    if factors.bounded:
        own, rest = F.broadcast(own), F.broadcast(rest)
    j = df.join(own, (df[category] == own["__c"]) & (df[unit] == own["__u"]), "left") \
        .join(rest, df[unit] == rest["__du"], "left")
    factor = F.when(F.col(category).isNotNull(), F.coalesce("__own", "__rest"))
    return j.withColumn(value, F.col(value) * factor).drop("__c", "__u", "__own", "__du", "__rest")
