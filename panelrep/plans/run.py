"""End-to-end report run: maps folder + stored project -> report + study CSVs.

    python -m panelrep.plans.run --project <root> --maps <dir> --out <dir> \
        [--studies mitigdecomp,main,diet] [--run-date 2020-01-02] [--safe]

The maps folder holds the wide lookup CSVs under their usual names
(:data:`panelrep.config.MAP_FILES`); the project is stored as
:mod:`panelrep.sources.store` describes.  Every group of indicators is written
as its own job to ``<out>/report/run=<id>/group=<codes>/indicator=<code>/``; the
study subsets are written to ``<out>/studies/run_date=<ddMonYYYY>/study=<name>/``.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import os

from pyspark.sql import SparkSession

from ..config import MAP_FILES, STUDY_FILE_PREFIX, ReportConfig
from ..session import get_session
from ..sources import bridges as B
from ..sources.facts import Project
from ..sources.sinks import study_table, write_studies
from .recipes.common import Bridges
from .report import build_indicators, read_report, write_report


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)  # noqa: SLF001


def load_bridges(spark: SparkSession, maps_dir: str, cfg: ReportConfig) -> Bridges:
    """Bridges from the wide map CSVs; the scenario pairs and waste maps are optional."""
    f = {k: f"{maps_dir.rstrip('/')}/{v}" for k, v in MAP_FILES.items()}
    waste = None
    if all(_exists(spark, f[k]) for k in ("waste_regions", "waste_commodities", "waste_fractions")):
        waste = B.waste_surface_csv(spark, f["waste_regions"], f["waste_commodities"], f["waste_fractions"])
    return Bridges(
        region=B.region_bridge_csv(spark, f["region"]),
        item=B.commodity_bridge_csv(spark, f["commodity"], keep_null_keys=cfg.parity),
        land=B.land_bridge_csv(spark, f["land"]),
        demand=B.demand_bridge_csv(spark, f["demand"]),
        pairs=B.scenario_pairs_csv(spark, f["pairs"]) if _exists(spark, f["pairs"]) else None,
        waste=waste,
    )


def run_report(spark: SparkSession, project_root: str, maps_dir: str, out: str, *,
               cfg: ReportConfig | None = None, studies=("mitigdecomp",), run_date: _dt.date | None = None,
               threads: int = 16, one_file_per_study: bool = False) -> dict[str, str]:
    """Build every indicator, write the report and the study subsets; return the paths."""
    cfg = cfg or ReportConfig()
    br = load_bridges(spark, maps_dir, cfg)
    project = Project.from_parquet(spark, project_root, cfg.years)
    report_root = write_report(build_indicators(project, br, cfg), f"{out.rstrip('/')}/report", threads=threads)
    chosen = {s: cfg.studies[s] for s in studies}
    prefixes = {s: STUDY_FILE_PREFIX.get(s, s) for s in chosen}
    studies_root = write_studies(read_report(spark, report_root), study_table(spark, chosen),
                                 f"{out.rstrip('/')}/studies", prefixes=prefixes, run_date=run_date,
                                 one_file_per_study=one_file_per_study)
    return {"report": report_root, "studies": studies_root}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--project", required=True)
    ap.add_argument("--maps", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--studies", default="mitigdecomp")
    ap.add_argument("--run-date", default=None, help="YYYY-MM-DD (default: today)")
    ap.add_argument("--safe", action="store_true", help="safe defaults instead of reference parity")
    ap.add_argument("--master", default=os.environ.get("SPARK_MASTER"))
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    cfg = ReportConfig(parity=not a.safe)
    run_date = _dt.date.fromisoformat(a.run_date) if a.run_date else None
    paths = run_report(spark, a.project, a.maps, a.out, cfg=cfg,
                       studies=[s for s in a.studies.split(",") if s], run_date=run_date)
    print(paths)


if __name__ == "__main__":
    main()
