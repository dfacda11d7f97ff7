"""Reporting template: constant tags, unit factors, conform to the 8 columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TEMPLATE_COLUMNS
from ..functions.nullmath import _col, contains_or_false, exact_lit, if_else3

TEMPLATE_TYPES = {"Model": "string", "Scenario": "string", "Region": "string", "Item": "string",
                  "Variable": "string", "Year": "int", "Unit": "string", "Value": "double"}


def tag(df: DataFrame, **consts) -> DataFrame:
    """Add (or overwrite) constant string columns, e.g. ``Variable='POPT'``."""
    return df.withColumns({k: F.lit(v) for k, v in consts.items() if v is not None})


def conform(df: DataFrame, **consts) -> DataFrame:
    """Add constant tags, then select the template columns with their types."""
    cols = []
    for c in TEMPLATE_COLUMNS:
        src = F.lit(consts[c]) if consts.get(c) is not None else F.col(c)
        cols.append(src.cast(TEMPLATE_TYPES[c]).alias(c))
    return df.select(*cols)


def scaled(c, *factors) -> Column:
    """``double(c) * f1 * f2 ...`` applied left to right (after a sum)."""
    out = _col(c).cast("double")
    for f in factors:
        out = out * F.lit(float(f))
    return out


def convert_by_category(value, category, special: str, special_factor, default_factor) -> Column:
    """Category-dependent unit factor; a null category gives a null value.

    Factors are exact literals so a decimal measure stays exact.
    """
    cond = _col(category) == F.lit(special)
    v = _col(value)
    return if_else3(cond, v * exact_lit(special_factor), v * exact_lit(default_factor))


def convert_by_pattern(value, label, rules: list[tuple[str, float]], default_factor) -> Column:
    """First rule whose text occurs in ``label`` gives the factor, else default.

    A null label matches no rule (so it takes the default).
    """
    v = _col(value)
    out = v * exact_lit(default_factor)
    for text, factor in reversed(rules):
        out = F.when(contains_or_false(label, text), v * exact_lit(factor)).otherwise(out)
    return out
