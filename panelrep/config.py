"""Report configuration.

A :class:`ReportConfig` carries everything a study varies: reporting years,
item lists per indicator, unit factors, scenario lists per study, and the
behaviour switches for reference oddities (``parity`` and friends).  Recipes
read it; nothing here touches Spark.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --------------------------------------------------------------------------
# Fixed values of the reporting template.  These must equal the values the
# existing reporting workflow uses, otherwise the numbers do not line up.
# --------------------------------------------------------------------------
TEMPLATE_COLUMNS = ("Model", "Scenario", "Region", "Item", "Variable", "Year", "Unit", "Value")

# lookup files of a maps folder and the header names used inside them (fixed values)
MAP_FILES = {
    "commodity": "commodity_map.csv", "demand": "demand_map.csv", "land": "land_map.csv",
    "region": "region_map.csv", "pairs": "YECC_scenario_map.csv", "waste_regions": "food_waste_regions.csv",
    "waste_commodities": "food_waste_commodities.csv", "waste_fractions": "food_waste_fractions.csv",
}
COMMODITY_MAP_NAME_COLUMNS = ("GCAM_commodity", "traded_commodity", "regional_commodity")
LAND_MAP_KEY_COLUMN = "GCAM_LUT"
WASTE_MAP_COMMODITY_COLUMN = "GCAM_commodity"
MODEL_NAME = "GCAM"
REPORT_YEARS = (2010, 2020, 2030, 2040, 2050)

# unit conversion factors (fixed values)
CONV_THOUSKM2_KHA = 100
CONV_BIO_EJ_TO_KT = 57100
CONV_BIO_EJ_TO_MT = 57.1
CONV_MT_TO_KT = 1000
CONV_KG_T = 1000
CONV_1975_2010_USD = 3.228
CONV_1990_2010_USD = 1.516
CONV_KGM2_THA = 10
CONV_PCAL_TO_GCAL = 1e6
CONV_YEAR_TO_DAYS = 365.25
CONV_C_TO_CO2 = 44 / 12
CONV_CH4_TO_CO2E = 28
CONV_N2O_TO_CO2E = 298
GDP_SCALE = 1.377  # million 1990 USD -> bn 2005 USD, applied after x1e-3
POP_SCALE = 1e-3

# item lists per indicator (fixed values)
LAND_ITEMS = ("CRP", "GRS", "ONV", "FOR", "NLD", "AGR", "ECP")
HARVESTED_AREA_ITEMS = ("RIC", "WHT", "CGR", "OSD", "SGC", "VFN", "VFN|VEG", "VFN|FRU", "VFN|NUT",
                        "PFB", "ECP", "OCR", "CRP", "AGR")
PROD_ITEMS = ("RIC", "WHT", "CGR", "OSD", "SGC", "VFN", "VFN|VEG", "VFN|FRU", "VFN|NUT",
              "PFB", "ECP", "OCR", "CRP", "RUM", "NRM", "NRM|PRK", "NRM|PTM", "DRY", "LSP", "FSH", "AGR", "GRS")
YEXO_ITEMS_EXCLUDE = "ECP"
PRICE_ITEMS = tuple(i for i in PROD_ITEMS if i != "GRS")
TRADE_ITEMS = PRICE_ITEMS
FRTN_ITEMS = HARVESTED_AREA_ITEMS
WATR_ITEMS = HARVESTED_AREA_ITEMS

# category names with a special rule (fixed values)
BIOMASS_SECTOR = "biomass"
BIOMASS_WEIGHT_YEAR = 2020
MEAT_EXPORT_SECTOR = "Exports_Meat"
TRADED_MARKER = "traded"
LUC_MARKER = "_LUC"
FEED_CLASSES = ("FeedCrops", "FodderHerb_Residue", "Pasture_FodderGrass")
PASSTHROUGH_FEED_CLASS = "Scavenging_Other"
PASSTHROUGH_FEED_INPUT = "Scavenging_Other_Rsrc"
FEED_ALLOC_ITEMS = (("FRUM", "RUM"), ("FDRY", "DRY"), ("FNRM", "NRM"))
ECO2_GHG = "CO2"
ECH4_GHGS = ("CH4_AGR", "CH4_AWB")
EN2O_GHGS = ("N2O_AGR", "N2O_AWB")
EMIS_GHGS = ("CO2", "CH4", "N2O", "CH4_AGR", "CH4_AWB", "N2O_AGR", "N2O_AWB")

# study scenario lists (fixed values)
NO_MITIG_SCENARIOS = ("SSP1_NoMt_NoCC", "SSP2_NoMt_NoCC", "SSP3_NoMt_NoCC", "SSP1_NoMt_CC26", "SSP2_NoMt_CC26",
                      "SSP3_NoMt_CC26", "SSP1_NoMt_CC85", "SSP2_NoMt_CC85", "SSP3_NoMt_CC85")
MITIG_SCENARIOS = ("SSP1_2p6_NoCC", "SSP1_2p6_CC26", "SSP2_2p6_NoCC", "SSP2_2p6_CC26", "SSP3_2p6_NoCC",
                   "SSP3_2p6_CC26")
MAIN_SCENARIOS = NO_MITIG_SCENARIOS + MITIG_SCENARIOS
DIET_SCENARIOS = ("SSP2_NoMt_NoCC", "SSP2_NoMt_NoCC_Diet_FlexA_WLD", "SSP2_NoMt_NoCC_Diet_FlexA_CHN",
                  "SSP2_NoMt_NoCC_Diet_FlexA_DEV", "SSP2_NoMt_NoCC_Diet_FlexA_EUR", "SSP2_NoMt_NoCC_Diet_FlexA_LAM",
                  "SSP2_NoMt_NoCC_Diet_FlexA_USA")
MITIG_DECOMP_SCENARIOS = ("SSP1_Baseline", "ModelB_SSP1_Mit_Full", "ModelB_SSP1_Mit_wNonCO2", "ModelB_SSP1_Mit_wBio",
                          "ModelB_SSP1_Mit_wAff", "SSP2_Baseline", "ModelB_SSP2_Mit_Full", "ModelB_SSP2_Mit_wNonCO2",
                          "ModelB_SSP2_Mit_wBio", "ModelB_SSP2_Mit_wAff", "SSP3_Baseline", "ModelB_SSP3_Mit_Full",
                          "ModelB_SSP3_Mit_wNonCO2", "ModelB_SSP3_Mit_wBio", "ModelB_SSP3_Mit_wAff")
STUDIES = {"main": MAIN_SCENARIOS, "diet": DIET_SCENARIOS, "mitigdecomp": MITIG_DECOMP_SCENARIOS}
STUDY_FILE_PREFIX = {"main": "GCAM_CORE_ALL", "diet": "GCAM_DIET_ALL", "mitigdecomp": "GCAM_MITIGDECOMP_ALL"}


@dataclass(frozen=True)
class ReportConfig:
    """Everything a study can vary.  Defaults reproduce the reference workflow.

    ``parity``: reproduce the reference's null handling exactly (null bridge
    keys are kept and joined null-safely, oddity Q1).  ``False`` drops null
    keys and joins with plain equality.
    ``per_scenario_base``: base year per scenario instead of over the whole
    table (oddity Q11).
    ``feed_alloc_factor``: factor on FRUM/FDRY/FNRM (oddity Q3; reference = 1).
    ``exact_sums``: sums of doubles that do not depend on the order of rows.
    ``pre_aggregate``: sum facts at their native grain before bridge fan-out.
    ``null_policy``: ``strict`` (a null input nulls its group, the reference)
    or ``skip`` (sums ignore nulls; oddity Q13).
    ``drop_unmapped``: drop rows whose commodity has no reporting item instead
    of keeping a null-Item group (oddity Q7).
    With ``parity=False`` base-year weights without a price or yield are
    dropped (inner join) instead of giving rows with a null year (oddity Q9).
    """

    model: str = MODEL_NAME
    years: tuple = REPORT_YEARS
    land_items: tuple = LAND_ITEMS
    area_items: tuple = HARVESTED_AREA_ITEMS
    prod_items: tuple = PROD_ITEMS
    price_items: tuple = PRICE_ITEMS
    trade_items: tuple = TRADE_ITEMS
    frtn_items: tuple = FRTN_ITEMS
    watr_items: tuple = WATR_ITEMS
    yexo_exclude: str = YEXO_ITEMS_EXCLUDE
    biomass_sector: str = BIOMASS_SECTOR
    biomass_weight_year: int = BIOMASS_WEIGHT_YEAR
    meat_export_sector: str = MEAT_EXPORT_SECTOR
    feed_classes: tuple = FEED_CLASSES
    passthrough_feed_class: str = PASSTHROUGH_FEED_CLASS
    passthrough_feed_input: str = PASSTHROUGH_FEED_INPUT
    feed_alloc_items: tuple = FEED_ALLOC_ITEMS
    ech4_ghgs: tuple = ECH4_GHGS
    en2o_ghgs: tuple = EN2O_GHGS
    emis_ghgs: tuple = EMIS_GHGS
    studies: dict = field(default_factory=lambda: dict(STUDIES))
    parity: bool = True
    per_scenario_base: bool = False
    exact_sums: bool = True
    feed_alloc_factor: float = 1
    pre_aggregate: bool = True
    share_target_rows: int = 1_000_000
    null_policy: str = "strict"
    drop_unmapped: bool = False

    @property
    def strict(self) -> bool:
        return self.null_policy == "strict"

    @property
    def unmapped_join(self) -> str:
        return "inner" if self.drop_unmapped else "left"

    @property
    def weight_join(self) -> str:
        return "left" if self.parity else "inner"

    def with_(self, **kw) -> "ReportConfig":
        return replace(self, **kw)
