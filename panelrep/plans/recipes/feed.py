"""Feed: FEED_INPUTS, feed efficiency FEEF, feed shares, FRUM / FDRY / FNRM."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import config as C
from ...config import ReportConfig
from ...functions.nullmath import if_else3, ieee_div
from ...operators.panel import Via, group_share
from ...operators.template import conform, scaled
from ...sources.bridges import Bridge
from .common import KEYS, Bridges, by_item, by_region, left_join_on, rollup


def feed_inputs(feed: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    """Feed use x1000 by animal Item (Scenario, Region, Item, Year, Value)."""
    s = rollup(feed, KEYS, ["value"], [by_region(br), by_item(br.item, "sector", cfg.unmapped_join)], cfg)
    return s.withColumn("Value", scaled("value", C.CONV_MT_TO_KT))  # replaces ``value``


def feef(an_prod_df: DataFrame, feed_in: DataFrame, match_nulls: bool = True) -> DataFrame:
    """Animal production over feed use, on the production rows."""
    f = feed_in.select(*KEYS, F.col("Value").alias("__feed"))
    j = left_join_on(an_prod_df, f, KEYS, match_nulls=match_nulls)
    return conform(j.withColumn("Value", ieee_div("Value", "__feed")), Variable="FEEF", Unit="kg prt/kg prt")


def feed_shares(ag_use: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Share of each crop input in its feed class, per (Scenario, region, class, Year)."""
    use = ag_use.filter(F.col("sector").isin(list(cfg.feed_classes)))
    s = group_share(use, ["Scenario", "region", "sector", "Year"], "value", target_rows=cfg.share_target_rows,
                    exact=cfg.exact_sums)
    return s.select("Scenario", "region", "sector", "input", "Year", "share")


def feed_by_crop(feed: DataFrame, shares: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Feed of each class spread over its crop inputs by share; the
    pass-through class goes whole to its one input."""
    f = feed.withColumnRenamed("input", "feed_class")
    s = shares.withColumnRenamed("sector", "feed_class")
    j = left_join_on(f, s, ["Scenario", "region", "feed_class", "Year"], match_nulls=cfg.parity)
    passthrough = F.col("feed_class") == F.lit(cfg.passthrough_feed_class)
    j = j.withColumn("input", if_else3(passthrough, F.lit(cfg.passthrough_feed_input), F.col("input")))
    j = j.withColumn("share", if_else3(passthrough, F.lit(1.0), F.col("share")))
    j = j.withColumn("value", F.col("value").cast("double") * F.col("share"))
    return j.select("Scenario", "region", "sector", "input", "Year", "value")


def _animal_variable_bridge(item: Bridge, alloc) -> Bridge:
    """commodity -> Variable code for the animal items of the allocation (FRUM: RUM, ...)."""
    codes = F.create_map(*[x for var, it in alloc for x in (F.lit(it), F.lit(var))])
    items = [it for _, it in alloc]
    return Bridge(item.small.map_df(lambda d: d.filter(F.col(item.value).isin(items))
                                    .select(item.key, codes[F.col(item.value)].alias("Variable"))),
                  item.key, "Variable")


def feed_alloc(feed: DataFrame, ag_use: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    """FRUM, FDRY, FNRM in one pass: feed by crop input for each animal group.

    The animal item of the feeding sector selects the Variable; the crop
    input is then bridged to its items and regions and summed.
    """
    by_crop = feed_by_crop(feed, feed_shares(ag_use, cfg), cfg)
    animal = _animal_variable_bridge(br.item, cfg.feed_alloc_items)
    s = rollup(by_crop, ["Scenario", "Region", "Item", "Variable", "Year"], ["value"],
               [Via(animal, "sector", "inner", "Variable"), by_item(br.item, "input", cfg.unmapped_join),
                by_region(br)], cfg)
    factors = [cfg.feed_alloc_factor] if cfg.feed_alloc_factor != 1 else []
    return conform(s.withColumn("Value", scaled("value", *factors)), Model=cfg.model, Unit="1000 t")
