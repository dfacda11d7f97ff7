"""Yields: YILD / YIIR / YIRF (production over area), YEXO (exogenous), YECC (climate shift)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import config as C
from ...config import ReportConfig
from ...functions.nullmath import fill_missing, ieee_div
from ...operators.colocated import BUCKET_KEY, colocated_join
from ...operators.panel import base_year_rows, baseline_shift
from ...operators.template import conform, convert_by_category, scaled
from .common import KEYS, Bridges, FirstYears, by_item, by_region, except_, left_join_on, rollup


def ratio_yield(area: DataFrame, prod: DataFrame, variable: str, keys, match_nulls: bool = True) -> DataFrame:
    """``production / area`` on the area rows; null and NaN become 0, Inf stays."""
    p = prod.select(*keys, F.col("Value").alias("__prod"))
    j = left_join_on(area, p, keys, match_nulls=match_nulls)
    v = fill_missing(ieee_div("__prod", "Value"), 0)
    return conform(j.withColumn("Value", v), Variable=variable, Unit="t/ha")


def yild(area: DataFrame, ag_prod: DataFrame, match_nulls: bool = True) -> DataFrame:
    return ratio_yield(area, ag_prod, "YILD", ["Model", "Scenario", "Region", "Item", "Year"], match_nulls)


def yiir(arir: DataFrame, ag_prod_ir: DataFrame, match_nulls: bool = True) -> DataFrame:
    return ratio_yield(arir, ag_prod_ir, "YIIR", KEYS, match_nulls)


def yirf(arrf: DataFrame, ag_prod_rf: DataFrame, match_nulls: bool = True) -> DataFrame:
    return ratio_yield(arrf, ag_prod_rf, "YIRF", KEYS, match_nulls)


def yexo(harvested: DataFrame, ag_yield: DataFrame, br: Bridges, cfg: ReportConfig,
         first: FirstYears | None = None) -> DataFrame:
    """Σ(base-year area x yield) / Σ base-year area, x10 (kg/m2 -> t/ha).

    The base-year area of a technology weights its yield in every year; a
    technology without a yield keeps a null sector, year and product.  ``first``
    has the first years of ``harvests`` where they are known.
    """
    base = base_year_rows(harvested, per=["Scenario"] if cfg.per_scenario_base else None,
                          first=(first or {}).get("harvests")).drop("Year")
    near = [BUCKET_KEY] if BUCKET_KEY in base.columns and BUCKET_KEY in ag_yield.columns else []
    base = base.select("Scenario", "region", "technology", F.col("value").alias("area"), *near)
    y = ag_yield.withColumn("value", convert_by_category("value", "sector", cfg.biomass_sector,
                                                         C.CONV_BIO_EJ_TO_MT, 1))
    y = y.select("Scenario", "region", "technology", "sector", "Year", F.col("value").alias("__yield"), *near)
    keys = ["Scenario", "region", "technology"]
    if near and cfg.parity:
        y = y.withColumnsRenamed({k: f"__y_{k}" for k in keys})
        j = colocated_join(base, y, [(k, f"__y_{k}") for k in keys], cfg.weight_join) \
            .drop(BUCKET_KEY, *[f"__y_{k}" for k in keys])
    else:
        j = left_join_on(base.drop(BUCKET_KEY), y.drop(BUCKET_KEY), keys, how=cfg.weight_join, match_nulls=cfg.parity)
    j = j.withColumn("prod", F.col("area") * F.col("__yield")).drop("__yield")
    s = rollup(j, KEYS, ["prod", "area"],
               [by_item(except_(br.item, cfg.yexo_exclude), "sector", "inner"), by_region(br)], cfg)
    value = scaled(ieee_div("prod", "area"), C.CONV_KGM2_THA)
    return conform(s.withColumn("Value", value), Model=cfg.model, Variable="YEXO", Unit="t/ha")


def yecc(yexo_df: DataFrame, br: Bridges) -> DataFrame:
    """(scenario / its no-climate-change baseline - 1) x 100, per template key."""
    out = baseline_shift(yexo_df, br.pairs, ["Model", "Region", "Item", "Variable", "Year", "Unit"])
    return conform(out, Variable="YECC", Unit="%")
