"""End-to-end run: wide map CSVs + stored project -> report + study CSVs."""

import csv
import datetime as dt
from collections import defaultdict

from pyspark.sql import functions as F

from panelrep.config import COMMODITY_MAP_NAME_COLUMNS, LAND_MAP_KEY_COLUMN, MAP_FILES, STUDY_FILE_PREFIX
from panelrep.plans import catalog, standin
from panelrep.plans.run import run_report


def _write(path, rows):
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator="\r\n").writerows([["" if v is None else v for v in r] for r in rows])


def _maps(spark, sf_dir, d):
    _write(d / MAP_FILES["commodity"], [list(COMMODITY_MAP_NAME_COLUMNS) + ["Item1", "Item2", "Item3", "Item4"]]
           + list(standin.ITEM_BRIDGE_WIDE))
    land = defaultdict(list)
    for k, v in standin.LAND_BRIDGE:
        land[k].append(v)
    _write(d / MAP_FILES["land"], [[LAND_MAP_KEY_COLUMN, "Item1", "Item2", "Item3", "Item4"]]
           + [[k] + v + [None] * (4 - len(v)) for k, v in land.items()])
    dem = defaultdict(list)
    for k, v in standin.DEMAND_BRIDGE:
        dem[k].append(v)
    _write(d / MAP_FILES["demand"], [["sector", "Var1", "Var2"]] + [[k] + v + [None] * (2 - len(v)) for k, v in dem.items()])
    reg = defaultdict(list)
    for r in standin.region_bridge(spark, sf_dir).df.collect():
        reg[r.region].append(r.report_region)
    _write(d / MAP_FILES["region"], [["region", "Region1", "Region2", "Region3"]]
           + [[k] + v + [None] * (3 - len(v)) for k, v in reg.items()])
    _write(d / MAP_FILES["pairs"], [["CC_Scenario", "NoCC_Scenario"]] + list(standin.BASELINE_PAIRS))


def test_run_report_end_to_end(spark, sf_small, tmp_path):
    S = catalog.stand_in(spark, sf_small)
    S.project
    maps = tmp_path / "maps"
    maps.mkdir()
    _maps(spark, sf_small, maps)
    paths = run_report(spark, S.project_root, str(maps), str(tmp_path / "out"), cfg=S.cfg,
                       studies=("main", "alt"), run_date=dt.date(2021, 3, 4))
    assert paths["studies"].endswith("run_date=04Mar2021")
    out = spark.read.option("header", True).option("nullValue", "NA").csv(paths["studies"])
    studies = {r.study: r.n for r in out.groupBy("study").agg(F.countDistinct("Scenario").alias("n")).collect()}
    main = STUDY_FILE_PREFIX["main"]  # the main study is named by its file prefix
    assert studies == {main: 3, "alt": 1}
    variables = {r.Variable for r in out.select("Variable").distinct().collect()}
    assert {"POPT", "GDPT", "LAND", "AREA", "PROD", "XPRP", "YILD", "YEXO", "FOOD", "IMPO", "EXPO", "NETT",
            "FRTN", "WATR", "CALO", "EMIS", "ECO2", "ECH4", "EN2O", "FEEF", "FRUM", "FDRY", "FNRM",
            "CTAX"} <= variables
    assert "CALI" not in variables  # no food-waste maps given
    assert "YECC" not in variables  # computed, not reported
    popt = catalog.rollup_population(spark, sf_small).count()
    assert out.filter((F.col("study") == main) & (F.col("Variable") == "POPT")).count() == popt


def test_cli_main(spark, sf_small, tmp_path, capsys):
    from panelrep.plans.run import main
    S = catalog.stand_in(spark, sf_small)
    S.project
    maps = tmp_path / "maps"
    maps.mkdir()
    _maps(spark, sf_small, maps)
    out = tmp_path / "cli"
    # reference configuration: its reporting years are not in the stand-in data, so the
    # report is empty -- it must still be written and read back as an empty template
    main(["--project", S.project_root, "--maps", str(maps), "--out", str(out), "--run-date", "2022-05-06"])
    printed = capsys.readouterr().out
    assert "run_date=06May2022" in printed
    from panelrep.plans.report import read_report
    empty = read_report(spark, str(out / "report"))
    assert empty.columns == ["Model", "Scenario", "Region", "Item", "Variable", "Year", "Unit", "Value"]
    assert empty.count() == 0


def test_reports_of_different_runs_do_not_mix(spark, tmp_path):
    from panelrep.plans.report import read_report, write_report
    schema = "Model string, Scenario string, Region string, Item string, Variable string, Year int, Unit string, Value double"

    def part(code):
        return spark.createDataFrame([("M", "A", "r", "TOT", code, 2010, "u", 1.0)], schema)

    root = str(tmp_path / "report")
    for codes in (("POPT", "GDPT", "CTAX"), ("POPT", "GDPT"), ("GDPT", "CTAX"), ()):
        run = write_report({c: part(c) for c in codes}, root)
        assert sorted(r.Variable for r in read_report(spark, run).collect()) == sorted(codes)
