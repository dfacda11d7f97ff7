"""Assemble every indicator into the reporting template.

``build_indicators`` returns one lazy DataFrame per variable code; shared
intermediates (split land cover, harvested area, crop production state) are
built once and referenced by several indicators, so Spark plans them once
per action and reuses their exchanges.  ``final_template`` unions the
reported ones (YECC is computed but not reported, as in the reference).

At scale, use :func:`write_report` instead of one huge plan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..config import TEMPLATE_COLUMNS, ReportConfig
from ..operators.bounded import local_table
from ..operators.panel import union_all
from ..session import file_system
from ..sources.facts import Project
from .recipes import emissions, feed, food, land, prices, production, totals, trade, yields
from .recipes.common import Bridges

REPORTED = ("POPT", "GDPT", "LAND", "AREA", "ARRF", "ARIR", "PROD", "XPRP", "YILD", "YIIR", "YIRF", "YEXO",
            "DEMAND", "IMPO", "EXPO", "NETT", "FRTN", "WATR", "CALO", "CALI", "EMIS", "ECO2", "ECH4", "EN2O",
            "FEEF", "FEED_ALLOC", "CTAX")


def build_indicators(p: Project, br: Bridges, cfg: ReportConfig, population: str = "population") -> dict[str, DataFrame]:
    t = p.table
    out: dict[str, DataFrame] = {}
    out["POPT"] = totals.popt(t(population), br, cfg)
    out["GDPT"] = totals.gdpt(t("gdp"), br, cfg)
    lnd = land.land_df(t("land_cover"))
    out["LAND"] = land.land(t("land_cover"), br, cfg)
    harvested = land.harvested_area_df(t("harvests"), lnd)
    out.update(land.areas(harvested, br, cfg))
    ag = production.ag_prod_variants(t("ag_prod"), br, cfg)
    out["PROD"] = production.prod(t("ag_prod"), t("an_prod"), br, cfg, ag_variants=ag)
    out["XPRP"] = prices.xprp(t("ag_prod"), t("an_prod"), t("ag_prices"), t("an_prices"), br, cfg, p.first_years)
    out["YILD"] = yields.yild(out["AREA"], ag["AG_PROD"], cfg.parity)
    out["YIIR"] = yields.yiir(out["ARIR"], ag["AG_PROD_IR"], cfg.parity)
    out["YIRF"] = yields.yirf(out["ARRF"], ag["AG_PROD_RF"], cfg.parity)
    out["YEXO"] = yields.yexo(harvested, t("ag_yield"), br, cfg, p.first_years)
    if br.pairs is not None:
        out["YECC"] = yields.yecc(out["YEXO"], br)
    out["DEMAND"] = food.demand(t("ag_use"), t("an_use"), br, cfg)
    out["IMPO"] = trade.impo(t("imports"), br, cfg)
    out["EXPO"] = trade.expo(t("exports"), br, cfg)
    out["NETT"] = trade.nett(out["EXPO"], out["IMPO"], cfg.parity)
    out["FRTN"] = trade.frtn(t("fertilizer"), br, cfg)
    out["WATR"] = trade.watr(t("water"), br, cfg)
    out["CALO"] = food.calo(t("food"), out["POPT"], br, cfg)
    if br.waste is not None:
        out["CALI"] = food.cali(t("food"), out["POPT"], br, cfg)
    out["EMIS"] = emissions.emis(t("emissions"), t("luc_emissions"), br, cfg)
    out["ECO2"] = emissions.eco2(t("emissions"), t("luc_emissions"), br, cfg)
    out["ECH4"] = emissions.ech4(t("emissions"), br, cfg)
    out["EN2O"] = emissions.en2o(t("emissions"), br, cfg)
    an = production.an_prod(t("an_prod"), br, cfg)
    out["FEEF"] = feed.feef(an, feed.feed_inputs(t("feed"), br, cfg), cfg.parity)
    out["FEED_ALLOC"] = feed.feed_alloc(t("feed"), t("ag_use"), br, cfg)
    co2 = t("co2_prices")
    if co2 is not None:
        out["CTAX"] = prices.ctax(co2, prices.report_scenarios(t(population)), br, cfg)
    return out


def final_template(indicators: dict[str, DataFrame]) -> DataFrame:
    """Union of the reported indicators in template columns (one plan)."""
    return union_all([indicators[k] for k in REPORTED if k in indicators])


# Indicators that share intermediates are written by one job, so that the
# shared state (crop production, harvested area, POPT, trade sums) is computed
# once per group through exchange reuse; groups run side by side.
REPORT_GROUPS = (
    ("POPT", "CALO", "CALI"),
    ("GDPT",),
    ("LAND",),
    ("AREA", "ARRF", "ARIR", "PROD", "YILD", "YIIR", "YIRF", "YEXO"),
    ("XPRP",),
    ("DEMAND",),
    ("IMPO", "EXPO", "NETT"),
    ("FRTN",),
    ("WATR",),
    ("EMIS", "ECO2", "ECH4", "EN2O"),
    ("FEEF",),
    ("FEED_ALLOC",),
    ("CTAX",),
)


def write_report(indicators: dict[str, DataFrame], root: str, *, threads: int = 16,
                 codes=REPORTED, groups=REPORT_GROUPS) -> str:
    """Write the indicators to a fresh ``root/run=<id>``, one job per group; returns that run's folder.

    A group's rows go to ``group=<codes>/indicator=<code>/``.  Nothing of an
    earlier run is read or changed.  Groups are independent plans: they run from a few driver threads (so
    small ones overlap), and the union is a plain read of the run's folder.  Indicators of
    one group share their intermediates within the group's plan.  This is the
    way to build a report at scale; :func:`final_template` is the single-plan
    form.  Codes not listed in ``groups`` form groups of their own.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    from pyspark.sql import functions as F

    wanted = [k for k in codes if k in indicators]
    listed = [[k for k in g if k in wanted] for g in groups]
    rest = [[k] for k in wanted if not any(k in g for g in listed)]
    todo = [g for g in listed + rest if g]
    root = f"{root.rstrip('/')}/run={uuid.uuid4().hex}"
    if not todo:
        return root

    @inheritable_thread_target(indicators[todo[0][0]].sparkSession)  # job group, pool, tags follow
    def write(item):
        n, group = item
        df = union_all([indicators[k].withColumn("indicator", F.lit(k)) for k in group])
        sc = df.sparkSession.sparkContext
        sc.setJobDescription(f"report group {'+'.join(group)}")
        sc.setLocalProperty("spark.scheduler.pool", f"report-{n}")  # FAIR share between groups
        df.write.mode("overwrite").partitionBy("indicator").parquet(f"{root}/group={'-'.join(group)}")

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        list(pool.map(write, list(enumerate(todo))))
    return root


def read_report(spark, root: str) -> DataFrame:
    """The template in the run folder that :func:`write_report` returned (all indicators).

    Read with the template schema, so a report without rows (e.g. no data in
    the reporting years) is an empty table rather than an error.
    """
    from ..operators.template import TEMPLATE_TYPES

    schema = ", ".join(f"{c} {TEMPLATE_TYPES[c]}" for c in TEMPLATE_COLUMNS)
    fs, p = file_system(spark, root)
    if not fs.exists(p):  # a run without indicators
        return local_table(spark, [], schema)
    return spark.read.schema(schema).parquet(root).select(*TEMPLATE_COLUMNS)
