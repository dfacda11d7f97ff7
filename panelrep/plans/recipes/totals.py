"""Region totals: POPT (population), GDPT (GDP)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ... import config as C
from ...config import ReportConfig
from ...operators.template import conform, scaled
from .common import KEYS_TOT, Bridges, by_region, rollup


def region_total(facts: DataFrame, br: Bridges, cfg: ReportConfig, *, variable: str, unit: str,
                 factors) -> DataFrame:
    """Σ value by (Scenario, Region, Year) through the region bridge, times factors."""
    s = rollup(facts, KEYS_TOT, ["value"], [by_region(br)], cfg)
    return conform(s.withColumn("Value", scaled("value", *factors)),
                   Model=cfg.model, Variable=variable, Unit=unit, Item="TOT")


def popt(population: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    return region_total(population, br, cfg, variable="POPT", unit="million", factors=[C.POP_SCALE])


def gdpt(gdp: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    return region_total(gdp, br, cfg, variable="GDPT", unit="bn USD 2005 MER", factors=[1e-3, C.GDP_SCALE])
