"""A report kept up to date scenario by scenario.

The report is a stored project of its own (:mod:`panelrep.sources.store`): one table
per indicator, one entry per scenario.  An update looks which scenarios of the
model project each table lacks, computes the indicators over those scenarios'
files only, and adds them in one commit.  Reading unites the tables.

Most indicators of a scenario need nothing of other scenarios.  The rest is kept
apart: the base year of XPRP and YEXO is the first of the whole project, told by
its manifest, and part of their tables' names, so that another base year starts
another table; ECH4 and EN2O are stored before, and filled up after, the items of
all scenarios are known; CTAX stores the prices that were observed, and its grid
of scenarios, years and regions is made when the report is read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..config import TEMPLATE_COLUMNS, ReportConfig
from ..operators.bounded import Small, local_table
from ..operators.panel import union_all
from ..operators.template import TEMPLATE_TYPES, conform
from ..sources import store
from ..sources.facts import Project
from .recipes import emissions, prices
from .recipes.common import Bridges, FirstYears
from .report import REPORTED, build_indicators

KEY = "Scenario"
#: Indicators that are stored before their grid is filled.
UNFILLED = ("ECH4", "EN2O", "CTAX")
#: The tables whose first years fix an indicator's base year.
BASED_ON = {"XPRP": ("ag_prod", "an_prod"), "YEXO": ("harvests",)}


def table_name(code: str, first: FirstYears, cfg: ReportConfig) -> str:
    """The table an indicator is stored in; what its rows depend on besides their scenario is part of the name."""
    if code in UNFILLED:
        return f"{code}-unfilled"
    if code in BASED_ON:
        base = ["own"] if cfg.per_scenario_base else [min(first.get(t, {}).values(), default=None) for t in BASED_ON[code]]
        return "-".join([code, *map(str, base)])
    return code


def _unfilled(code: str, p: Project, br: Bridges, cfg: ReportConfig) -> DataFrame | None:
    if code == "CTAX":
        co2 = p.table("co2_prices")
        return None if co2 is None else prices.observed_prices(co2)
    return (emissions.ech4_sums if code == "ECH4" else emissions.en2o_sums)(p.table("emissions"), br, cfg)


def _snapshots(spark: SparkSession, project_root: str, report_root: str, cfg: ReportConfig) \
        -> tuple[store.Snapshot, FirstYears, store.Snapshot]:
    facts = store.adopt(spark, project_root)
    first = {q: facts.first_years(q, cfg.years) or {} for q in facts.queries()}
    return facts, first, store.snapshot(spark, report_root) or store.Snapshot()


def update_report(spark: SparkSession, project_root: str, br: Bridges, cfg: ReportConfig, report_root: str,
                  scenarios: Sequence[str | None] | None = None, codes: Sequence[str] = REPORTED) \
        -> Mapping[str, list[str | None]]:
    """Adds what the report lacks of the project's scenarios (all, or those given); the scenarios added per table.

    A scenario's tables should have come with one ingest: the report takes it as
    it is then.  Bridges and configuration must stay those of the earlier updates.
    """
    facts, first, have = _snapshots(spark, project_root, report_root, cfg)
    known = dict.fromkeys(s for _, s in facts.entries)
    wanted = [s for s in known if scenarios is None or s in set(scenarios)]
    lacking: dict[tuple[str | None, ...], list[str]] = {}
    for code in codes:
        missing = tuple(s for s in wanted if (table_name(code, first, cfg), s) not in have.entries)
        if missing:
            lacking.setdefault(missing, []).append(code)
    new, done = store.Ingest(spark, report_root, KEY), {}
    for missing, group in lacking.items():
        p = Project.from_parquet(spark, project_root, cfg.years, scenarios=missing, version=facts.version)
        if not cfg.per_scenario_base:  # the base year is that of the whole project, whatever part of it is read
            p.first_years = first
        built, tables = build_indicators(p, br, cfg), {}
        for code in group:
            df = _unfilled(code, p, br, cfg) if code in UNFILLED else built.get(code)
            if df is not None:
                name = table_name(code, first, cfg)
                tables[name], done[name] = df, missing
        new.add_all(tables)
    return new.commit(done)


def read_updated(spark: SparkSession, project_root: str, br: Bridges, cfg: ReportConfig, report_root: str,
                 codes: Sequence[str] = REPORTED) -> DataFrame:
    """The report as it stands, in template columns."""
    facts, first, have = _snapshots(spark, project_root, report_root, cfg)
    out = []
    for code in codes:
        df = store.read(spark, report_root, table_name(code, first, cfg), have)
        if df is None:
            continue
        if code == "CTAX":
            reported = [(s,) for s in facts.scenarios("population") if ("POPT", s) in have.entries]
            df = prices.ctax_grid(df, Small(local_table(spark, reported, "Scenario string")), br, cfg)
        elif code in UNFILLED:
            df = (emissions.ech4_filled if code == "ECH4" else emissions.en2o_filled)(df, cfg)
        out.append(conform(df))
    if not out:
        return local_table(spark, [], ", ".join(f"{c} {TEMPLATE_TYPES[c]}" for c in TEMPLATE_COLUMNS))
    return union_all(out)
