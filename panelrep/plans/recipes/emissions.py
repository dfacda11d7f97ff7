"""Emissions: ECO2, ECH4, EN2O, EMIS (CO2-equivalents)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import config as C
from ...config import ReportConfig
from ...operators.panel import OBSERVED, densify, union_all
from ...operators.template import conform, convert_by_pattern, scaled
from .common import KEYS, KEYS_TOT, Bridges, by_item, by_region, rollup


def eco2(emissions: DataFrame, luc: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    """Total CO2: sector CO2 plus land-use change (a table without a gas column)."""
    co2 = emissions.filter(F.col("ghg") == C.ECO2_GHG)
    both = union_all([co2.select("Scenario", "region", "Year", "value"), luc.select("Scenario", "region", "Year", "value")])
    s = rollup(both, KEYS_TOT, ["value"], [by_region(br)], cfg)
    return conform(s.withColumn("Value", scaled("value", C.CONV_C_TO_CO2)),
                   Model=cfg.model, Variable="ECO2", Item="TOT", Unit="MtCO2e")


def _gas_sums(emissions: DataFrame, gases, factor, br: Bridges, cfg: ReportConfig) -> DataFrame:
    g = emissions.filter(F.col("ghg").isin(list(gases)))
    s = rollup(g, KEYS, ["value"], [by_region(br), by_item(br.item, "sector", "inner")], cfg)
    return s.withColumn("Value", scaled("value", factor))  # replaces ``value``


def _gas_filled(sums: DataFrame, variable: str, cfg: ReportConfig) -> DataFrame:
    s = densify(sums, ["Scenario", "Region"], {"Item": OBSERVED, "Year": cfg.years}, {"Value": 0})
    return conform(s, Model=cfg.model, Variable=variable, Unit="MtCO2e")


def ech4_sums(emissions: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    return _gas_sums(emissions, cfg.ech4_ghgs, C.CONV_CH4_TO_CO2E, br, cfg)


def en2o_sums(emissions: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    return _gas_sums(emissions, cfg.en2o_ghgs, C.CONV_N2O_TO_CO2E, br, cfg)


def ech4_filled(sums: DataFrame, cfg: ReportConfig) -> DataFrame:
    """ECH4 from its sums, which may come from several runs: items observed in any scenario, every year."""
    return _gas_filled(sums, "ECH4", cfg)


def en2o_filled(sums: DataFrame, cfg: ReportConfig) -> DataFrame:
    return _gas_filled(sums, "EN2O", cfg)


def ech4(emissions: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    return ech4_filled(ech4_sums(emissions, br, cfg), cfg)


def en2o(emissions: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    return en2o_filled(en2o_sums(emissions, br, cfg), cfg)


def emis(emissions: DataFrame, luc: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    """All gases in CO2e: the factor is chosen per row from the gas name
    (N2O, then CH4, else carbon -> CO2); a missing gas counts as CO2."""
    g = emissions.filter(F.col("ghg").isin(list(cfg.emis_ghgs))).select("Scenario", "region", "ghg", "Year", "value")
    both = union_all([g, luc.select("Scenario", "region", "Year", "value")])
    both = both.withColumn("ghg", F.coalesce(F.col("ghg"), F.lit(C.ECO2_GHG)))
    both = both.withColumn("value", convert_by_pattern("value", "ghg", [("N2O", C.CONV_N2O_TO_CO2E),
                                                                          ("CH4", C.CONV_CH4_TO_CO2E)],
                                                       C.CONV_C_TO_CO2))
    s = rollup(both, KEYS_TOT, ["value"], [by_region(br)], cfg)
    return conform(s.withColumn("Value", scaled("value")), Model=cfg.model, Item="TOT", Variable="EMIS", Unit="MtCO2e")
