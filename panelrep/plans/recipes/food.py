"""Commodity disposition (FOOD, FEED, OTHU, CONS) and calories per capita (CALO, CALI)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import config as C
from ...config import ReportConfig
from ...functions.nullmath import exact_lit, ieee_div
from ...operators.panel import Via, union_all
from ...operators.template import conform, scaled
from .common import KEYS, KEYS_TOT, Bridges, by_item, by_region, left_join_on, rollup


def demand(ag_use: DataFrame, an_use: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    """Σ use x1000 by disposition Variable; crop and animal uses are unioned first
    and summed once, so aggregate items add up over both."""
    cols = ["Scenario", "region", "sector", "input", "Year", "value"]
    both = union_all([ag_use.select(*cols), an_use.select(*cols)])
    s = rollup(both, ["Scenario", "Region", "Variable", "Item", "Year"], ["value"],
               [Via(br.demand, "sector", "inner", "Variable"), by_item(br.item, "input", cfg.unmapped_join),
                by_region(br)], cfg)
    return conform(s.withColumn("Value", scaled("value", C.CONV_MT_TO_KT)), Model=cfg.model, Unit="1000 t")


def _per_capita(kcal: DataFrame, popt: DataFrame, variable: str, cfg: ReportConfig) -> DataFrame:
    pop = popt.select(*KEYS_TOT, F.col("Value").alias("__pop"))
    j = left_join_on(kcal, pop, KEYS_TOT, match_nulls=cfg.parity)
    v = ieee_div(scaled("value", C.CONV_PCAL_TO_GCAL), "__pop") / F.lit(C.CONV_YEAR_TO_DAYS)
    return conform(j.withColumn("Value", v), Model=cfg.model, Variable=variable, Unit="kcal/cap/d")


def calo(food: DataFrame, popt: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    """Calories available per person and day."""
    s = rollup(food, KEYS, ["value"], [by_item(br.item, "subsector", cfg.unmapped_join), by_region(br)], cfg)
    return _per_capita(s, popt, "CALO", cfg)


def cali(food: DataFrame, popt: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    """Calories net of the food-waste fraction of (native region, commodity)."""
    w = br.waste.df.select(F.col("region").alias("__wr"), F.col("commodity_key").alias("__wc"), "waste_frac")
    if br.waste.bounded:
        w = F.broadcast(w)
    if cfg.parity:
        cond = food["region"].eqNullSafe(w["__wr"]) & food["subsector"].eqNullSafe(w["__wc"])
    else:
        cond = (food["region"] == w["__wr"]) & (food["subsector"] == w["__wc"])
    net = (food.join(w, cond, "left").drop("__wr", "__wc")
           .withColumn("value", F.col("value") * (exact_lit(1) - F.col("waste_frac"))).drop("waste_frac"))
    s = rollup(net, KEYS, ["value"], [by_item(br.item, "subsector", cfg.unmapped_join), by_region(br)], cfg)
    return _per_capita(s, popt, "CALI", cfg)
