"""Trade: IMPO, EXPO (origin recovered from labels), NETT; inputs FRTN, WATR."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import config as C
from ...config import ReportConfig
from ...functions.text import recover_origin
from ...operators.panel import densify
from ...operators.template import conform, scaled
from .common import KEYS, Bridges, by_item, by_region, left_join_on, rollup

TEMPLATE_KEYS = ["Model", "Scenario", "Region", "Item", "Year", "Unit"]


def _densified(s: DataFrame, items, cfg: ReportConfig, factors, variable: str, unit: str) -> DataFrame:
    s = s.withColumn("Value", scaled("value", *factors))  # replaces ``value`` (names are case-insensitive)
    s = densify(s, ["Scenario", "Region"], {"Item": items, "Year": cfg.years}, {"Value": 0})
    return conform(s, Model=cfg.model, Variable=variable, Unit=unit)


def impo(imports: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    s = rollup(imports, KEYS, ["value"], [by_item(br.item, "sector", "inner"), by_region(br)], cfg)
    return _densified(s, cfg.trade_items, cfg, [C.CONV_MT_TO_KT], "IMPO", "1000 t")


def expo(exports: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    fixed = recover_origin(exports, meat_export_sector=cfg.meat_export_sector, traded_marker=C.TRADED_MARKER)
    s = rollup(fixed, KEYS, ["value"], [by_item(br.item, "sector", "inner"), by_region(br)], cfg)
    return _densified(s, cfg.trade_items, cfg, [C.CONV_MT_TO_KT], "EXPO", "1000 t")


def nett(expo_df: DataFrame, impo_df: DataFrame, match_nulls: bool = True) -> DataFrame:
    """Exports minus imports on the export rows."""
    imp = impo_df.select(*TEMPLATE_KEYS, F.col("Value").alias("__imp"))
    j = left_join_on(expo_df, imp, TEMPLATE_KEYS, match_nulls=match_nulls)
    return conform(j.withColumn("Value", F.col("Value") - F.col("__imp")), Variable="NETT")


def frtn(fertilizer: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    """Fertilizer by crop; commodities outside the item bridge are dropped."""
    s = rollup(fertilizer, KEYS, ["value"], [by_item(br.item, "sector", "inner"), by_region(br)], cfg)
    return _densified(s, cfg.frtn_items, cfg, [C.CONV_MT_TO_KT], "FRTN", "1000 t")


def watr(water: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    """Irrigation water by crop; an unmapped commodity stays as a null Item group."""
    s = rollup(water, KEYS, ["value"], [by_item(br.item, "sector", cfg.unmapped_join), by_region(br)], cfg)
    return _densified(s, cfg.watr_items, cfg, [], "WATR", "km3")

