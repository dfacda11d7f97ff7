"""Land use: LAND, and harvested area AREA / ARRF (rainfed) / ARIR (irrigated)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import config as C
from ...config import ReportConfig
from ...functions.text import with_split_key
from ...operators.colocated import BUCKET_KEY, colocated_join
from ...operators.panel import bridged_state, finish_sum
from ...operators.template import conform, scaled
from .common import KEYS, Bridges, by_item, by_region, only, rollup

LEAF_PARTS = ["land_type", "basin", "IRR_RFD", "MGMT_level"]


def land_df(land_cover: DataFrame) -> DataFrame:
    """Land cover with its leaf key split into land type, basin, water, management."""
    return with_split_key(land_cover.drop("Units"), "landleaf", LEAF_PARTS)


def harvested_area_df(harvests: DataFrame, land: DataFrame) -> DataFrame:
    """Harvests per year x land area of the same leaf (a fact-fact left join).

    The leaf parts come from the land side, so a harvest row without land
    has null parts (and a null product).  Of tables that are bucketed by scenario,
    region and leaf (:mod:`panelrep.operators.colocated`) no row is shuffled.
    """
    h = harvests.drop("Units", "sector", "subsector").withColumnRenamed("value", "__h")
    near = BUCKET_KEY in h.columns and BUCKET_KEY in land.columns
    l = (land.select("Scenario", "region", "landleaf", "Year", *LEAF_PARTS, F.col("value").alias("__l"),
                     *([BUCKET_KEY] if near else []))
         .withColumnsRenamed({"Scenario": "__ls", "region": "__lr", "landleaf": "__ll", "Year": "__ly"}))
    if near:
        out = colocated_join(h, l, [("Scenario", "__ls"), ("region", "__lr"), ("technology", "__ll"), ("Year", "__ly")]) \
            .drop("__ls", "__lr", "__ll", "__ly")
        return out.withColumn("value", F.col("__h") * F.col("__l")).drop("__h", "__l")
    cond = (h["Scenario"].eqNullSafe(l["__ls"]) & h["region"].eqNullSafe(l["__lr"])
            & h["technology"].eqNullSafe(l["__ll"]) & h["Year"].eqNullSafe(l["__ly"]))
    out = h.join(l, cond, "left").drop("__ls", "__lr", "__ll", "__ly")
    return out.withColumn("value", F.col("__h") * F.col("__l")).drop("__h", "__l")


def land(land_cover: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    s = rollup(land_df(land_cover), KEYS, ["value"],
               [by_item(only(br.land, cfg.land_items), "land_type", "inner"), by_region(br)], cfg)
    return conform(s.withColumn("Value", scaled("value", C.CONV_THOUSKM2_KHA)),
                   Model=cfg.model, Variable="LAND", Unit="1000 ha")


def area_state(harvested: DataFrame, br: Bridges, cfg: ReportConfig) -> DataFrame:
    """One aggregation keyed additionally by IRR_RFD; AREA, ARRF, ARIR re-merge it."""
    return bridged_state(harvested, KEYS + ["IRR_RFD"], ["value"],
                         [by_item(only(br.land, cfg.area_items), "land_type", "inner"), by_region(br)],
                         pre_aggregate=cfg.pre_aggregate, match_nulls=cfg.parity, exact=cfg.exact_sums)


def _area_from_state(state: DataFrame, cfg: ReportConfig, variable: str, water: str | None) -> DataFrame:
    if water is not None:
        state = state.filter(F.col("IRR_RFD") == water)
    s = finish_sum(state, KEYS, ["value"], strict=cfg.strict)
    return conform(s.withColumn("Value", scaled("value", C.CONV_THOUSKM2_KHA)),
                   Model=cfg.model, Variable=variable, Unit="1000 ha")


def areas(harvested: DataFrame, br: Bridges, cfg: ReportConfig) -> dict[str, DataFrame]:
    state = area_state(harvested, br, cfg)
    return {"AREA": _area_from_state(state, cfg, "AREA", None),
            "ARRF": _area_from_state(state, cfg, "ARRF", "RFD"),
            "ARIR": _area_from_state(state, cfg, "ARIR", "IRR")}
