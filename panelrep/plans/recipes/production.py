"""Production: crop (AG_PROD and its irrigated/rainfed parts), animal (AN_PROD), PROD."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import config as C
from ...config import ReportConfig
from ...functions.nullmath import exact_lit
from ...functions.text import with_split_key
from ...operators.panel import bridged_state, densify, finish_sum, grouped_sum, union_all
from ...operators.template import conform, convert_by_category, tag
from .common import KEYS, Bridges, by_item, by_region, only, rollup
from .land import LEAF_PARTS

TEMPLATE_NEST = ["Model", "Scenario", "Region", "Item", "Variable", "Unit"]


def ag_prod_df(ag_prod: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Crop production with technology parts, in kt (biomass from EJ, others from Mt)."""
    df = with_split_key(ag_prod, "technology", LEAF_PARTS)
    return df.withColumn("value", convert_by_category("value", "sector", cfg.biomass_sector,
                                                      C.CONV_BIO_EJ_TO_KT, C.CONV_MT_TO_KT))


def crop_state(ag_prod: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    return bridged_state(ag_prod, KEYS + ["IRR_RFD"], ["value"],
                         [by_item(only(br.item, cfg.prod_items), "sector", "inner"), by_region(br)],
                         pre_aggregate=cfg.pre_aggregate, match_nulls=cfg.parity, exact=cfg.exact_sums)


def ag_prod_variants(ag_prod: DataFrame, br: Bridges, cfg: ReportConfig) -> dict[str, DataFrame]:
    """AG_PROD (all), AG_PROD_IR, AG_PROD_RF, each with every reporting year (0 filled)."""
    state = crop_state(ag_prod_df(ag_prod, cfg), br, cfg)
    total = tag(finish_sum(state, KEYS, ["value"], strict=cfg.strict).withColumnRenamed("value", "Value"),
                Model=cfg.model, Variable="PROD", Unit="1000 t")
    out = {"AG_PROD": densify(total, TEMPLATE_NEST, {"Year": cfg.years}, {"Value": 0})}
    for name, water in (("AG_PROD_IR", "IRR"), ("AG_PROD_RF", "RFD")):
        part = (finish_sum(state.filter(F.col("IRR_RFD") == water), KEYS, ["value"], strict=cfg.strict)
                .withColumnRenamed("value", "Value"))
        out[name] = densify(part, ["Scenario", "Region", "Item"], {"Year": cfg.years}, {"Value": 0})
    return out


def an_prod_df(an_prod: DataFrame) -> DataFrame:
    return an_prod.withColumn("value", F.col("value") * exact_lit(C.CONV_MT_TO_KT))


def an_prod(an_prod_tbl: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    """Animal production in kt; every commodity is kept (a null Item group too)."""
    s = rollup(an_prod_df(an_prod_tbl), KEYS, ["value"],
               [by_item(br.item, "sector", cfg.unmapped_join), by_region(br)], cfg)
    return tag(s.withColumnRenamed("value", "Value"), Model=cfg.model, Variable="PROD", Unit="1000 t")


def prod(ag_prod: DataFrame, an_prod_tbl: DataFrame, br: Bridges, cfg: ReportConfig,
         ag_variants: dict | None = None) -> DataFrame:
    """Crops + animals re-summed so that aggregate items cover both."""
    crops = (ag_variants or ag_prod_variants(ag_prod, br, cfg))["AG_PROD"]
    both = union_all([crops.select(*TEMPLATE_NEST, "Year", "Value"),
                      an_prod(an_prod_tbl, br, cfg).select(*TEMPLATE_NEST, "Year", "Value")])
    return conform(grouped_sum(both, TEMPLATE_NEST + ["Year"], ["Value"], strict=cfg.strict, exact=cfg.exact_sums))
