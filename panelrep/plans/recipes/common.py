"""Shared pieces of the indicator recipes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...config import ReportConfig
from ...operators.bounded import Small
from ...operators.panel import Via, expand_and_sum
from ...sources.bridges import Bridge

FirstYears = Mapping[str, Mapping[str | None, int]]  # table -> scenario -> first reporting year
KEYS = ["Scenario", "Region", "Item", "Year"]
KEYS_TOT = ["Scenario", "Region", "Year"]


@dataclass(frozen=True)
class Bridges:
    """The user-supplied lookups a report needs."""

    region: Bridge          # region -> Region
    item: Bridge            # commodity_key -> Item (all spellings)
    land: Bridge            # land_type -> Item
    demand: Bridge          # sector -> Variable
    pairs: Small | None = None   # (CC_Scenario, NoCC_Scenario)
    waste: Small | None = None   # (region, commodity_key, waste_frac)


def only(bridge: Bridge, values) -> Bridge:
    """Bridge restricted to some categories (inner join + membership filter in one)."""
    vals = list(values)
    return Bridge(bridge.small.map_df(lambda d: d.filter(F.col(bridge.value).isin(vals))), bridge.key, bridge.value)


def except_(bridge: Bridge, value) -> Bridge:
    return Bridge(bridge.small.map_df(lambda d: d.filter(F.col(bridge.value) != F.lit(value))),
                  bridge.key, bridge.value)


def by_region(br: Bridges) -> Via:
    return Via(br.region, "region", "left", "Region")


def by_item(bridge: Bridge, on: str, how: str = "left") -> Via:
    return Via(bridge, on, how, "Item")


def rollup(df: DataFrame, group_by, values, vias, cfg: ReportConfig) -> DataFrame:
    return expand_and_sum(df, group_by, values, vias, pre_aggregate=cfg.pre_aggregate,
                          match_nulls=cfg.parity, strict=cfg.strict, exact=cfg.exact_sums)


def safe_join_keys(left: DataFrame, right: DataFrame, keys, prefix: str, match_nulls: bool = True):
    """Rename ``keys`` of ``right`` with ``prefix`` and return the (null-safe, if wanted) condition."""
    r = right
    for k in keys:
        r = r.withColumnRenamed(k, f"{prefix}{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"{prefix}{k}"]) if match_nulls else left[k] == r[f"{prefix}{k}"]
        cond = c if cond is None else cond & c
    return r, cond


def left_join_on(left: DataFrame, right: DataFrame, keys, prefix: str = "__r_", how: str = "left",
                 match_nulls: bool = True) -> DataFrame:
    """Left (or ``how``) join on ``keys``, nulls matching nulls if wanted; right key columns are dropped."""
    r, cond = safe_join_keys(left, right, keys, prefix, match_nulls)
    return left.join(r, cond, how).drop(*[f"{prefix}{k}" for k in keys])
