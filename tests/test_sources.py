"""Bridge readers, project layout, no-clobber ingest, template sinks."""

import csv
import datetime as dt
import os

from pyspark.sql import functions as F

from panelrep.config import COMMODITY_MAP_NAME_COLUMNS, WASTE_MAP_COMMODITY_COLUMN
from panelrep.sources.bridges import (commodity_bridge_csv, demand_bridge_csv, read_map_csv, region_bridge_csv,
                                      waste_surface_csv)
from panelrep.sources.facts import Project, ingest_no_clobber, ingest_project, rows_to_append, stack_scenarios
from panelrep.sources.sinks import study_subset, study_table, write_studies, write_template_csv


def _csv(path, rows):
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator="\r\n").writerows(rows)
    return str(path)


def test_blank_is_null_but_na_text_is_kept(spark, tmp_path):
    p = _csv(tmp_path / "m.csv", [["sector", "Var1", "Var2"], ["use_a", "FOOD", ""], ["NA", "FEED", "CONS"]])
    b = demand_bridge_csv(spark, p)
    got = sorted((r.sector, r.Variable) for r in b.df.collect())
    assert got == [("NA", "CONS"), ("NA", "FEED"), ("use_a", "FOOD")]
    assert b.small.bounded


def test_na_text_null_option(spark, tmp_path):
    p = _csv(tmp_path / "n.csv", [["a", "b"], ["x", "NA"]])
    assert read_map_csv(spark, p, na_text=True).collect()[0].b is None
    assert read_map_csv(spark, p).collect()[0].b == "NA"


def test_region_and_commodity_bridges_from_csv(spark, tmp_path):
    rp = _csv(tmp_path / "r.csv", [["region", "Region1", "Region2", "Region3"], ["north", "N", "", "ALL"],
                                   ["south", "S", "LOW", "ALL"]])
    rb = region_bridge_csv(spark, rp)
    assert rb.df.count() == 5
    cp = _csv(tmp_path / "c.csv", [list(COMMODITY_MAP_NAME_COLUMNS) + ["Item1", "Item2"],
                                   ["Corn", "traded corn", "", "CGR", "CRP"], ["Root", "", "", "OCR", ""]])
    ib = commodity_bridge_csv(spark, cp)
    rows = ib.df.collect()
    assert len(rows) == 3 * 2 + 3 * 1
    assert sum(1 for r in rows if r.commodity_key is None) == 1 * 2 + 2 * 1
    safe = commodity_bridge_csv(spark, cp, keep_null_keys=False)
    assert safe.df.filter(F.col("commodity_key").isNull()).count() == 0


def test_waste_surface_with_class_without_member(spark, tmp_path):
    regions = _csv(tmp_path / "wr.csv", [["region", "food_waste_region"], ["north", "EUR_w"], ["south", "AFR_w"]])
    comms = _csv(tmp_path / "wc.csv", [[WASTE_MAP_COMMODITY_COLUMN, "commodity"], ["Corn", "cereals"]])
    fracs = _csv(tmp_path / "wf.csv", [["commodity", "EUR_w", "AFR_w"], ["cereals", "0.1", "0.2"],
                                       ["eggs", "0.05", "0.07"]])
    s = waste_surface_csv(spark, regions, comms, fracs)
    rows = sorted((r.region, r.commodity_key or "", r.waste_frac) for r in s.df.collect())
    assert rows == [("north", "", 0.05), ("north", "Corn", 0.1), ("south", "", 0.07), ("south", "Corn", 0.2)]


def test_stack_scenarios_fills_missing_columns(spark):
    a = spark.createDataFrame([("A", "r", 1.0)], "scenario string, region string, value double")
    b = spark.createDataFrame([("B", 2.0)], "scenario string, value double")
    rows = sorted(tuple(r) for r in stack_scenarios([a, b]).collect())
    assert rows == [("A", "r", 1.0), ("B", None, 2.0)]


def test_ingest_is_no_clobber_and_idempotent(spark, tmp_path):
    root = str(tmp_path / "proj")
    first = spark.createDataFrame([("N", "r", 2010, 1.0)], "scenario string, region string, year int, value double")
    ingest_no_clobber(spark, first, root, "population")
    incoming = spark.createDataFrame([("A", "r", 2010, 5.0), ("N", "r", 2010, 9.0)],
                                     "scenario string, region string, year int, value double")
    assert [r.scenario for r in rows_to_append(incoming, spark.read.parquet(f"{root}/query=population"))
            .collect()] == ["A"]
    ingest_no_clobber(spark, incoming, root, "population")
    ingest_no_clobber(spark, incoming, root, "population")  # re-run: nothing new
    proj = Project.from_parquet(spark, root, [2010], names=["population"])
    got = sorted((r.Scenario, r.value) for r in proj.table("population").collect())
    assert got == [("A", 5.0), ("N", 1.0)]


def test_partition_pruning_on_scenario(spark, tmp_path):
    root = str(tmp_path / "proj2")
    df = spark.createDataFrame([("A", "r", 2010, 1.0), ("B", "r", 2010, 2.0)],
                               "scenario string, region string, year int, value double")
    df.write.partitionBy("scenario").parquet(f"{root}/query=gdp")
    proj = Project.from_parquet(spark, root, [2010], scenarios=["B"], names=["gdp"])
    t = proj.table("gdp")
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "scenario" in plan
    assert [r.value for r in t.collect()] == [2.0]


def test_template_csv_writes_na_for_null(spark, tmp_path):
    df = spark.createDataFrame([("M", "A", None, "TOT", "POPT", 2010, "million", None)],
                               "Model string, Scenario string, Region string, Item string, Variable string, "
                               "Year int, Unit string, Value double")
    out = str(tmp_path / "csv")
    write_template_csv(df.coalesce(1), out)
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.endswith(".csv"))
    assert '"Model","Scenario"' in text and '"M","A",NA,"TOT","POPT",2010,"million",NA' in text


def test_template_csv_quotes_text_and_writes_inf(spark, tmp_path):
    df = spark.createDataFrame([('say "x", y', float("inf")), ("b", float("-inf")), ("c", 1.5)], "Item string, Value double")
    write_template_csv(df.coalesce(1), str(tmp_path / "csv"))
    text = "".join(open(tmp_path / "csv" / f).read() for f in os.listdir(tmp_path / "csv") if f.endswith(".csv"))
    assert text.splitlines() == ['"Item","Value"', '"say ""x"", y",Inf', '"b",-Inf', '"c",1.5']
    assert list(csv.reader(text.splitlines()))[1] == ['say "x", y', "Inf"]


def test_second_study_of_a_day_leaves_the_first(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.0), ("N", 2.0)], "Scenario string, Value double")
    day, root = dt.date(2020, 1, 2), str(tmp_path / "s")
    for study, scenarios in (("main", ["A", "N"]), ("diet", ["N"]), ("diet", ["A"])):
        out = write_studies(df, study_table(spark, {study: scenarios}), root, run_date=day, fmt="parquet")
    assert sorted((r.study, r.Scenario) for r in spark.read.parquet(out).collect()) == [
        ("diet", "A"), ("main", "A"), ("main", "N")]
    write_studies(df, study_table(spark, {"main": ["Z"]}), root, run_date=day)  # now empty
    assert not [f for f in os.listdir(os.path.join(out, "study=main")) if f.endswith(".parquet")]


def test_columns_of_some_scenarios_only(spark, tmp_path):
    root = str(tmp_path / "mixed")
    a = spark.createDataFrame([("r", 2010, 1.0)], "region string, year int, value double")
    b = spark.createDataFrame([("r", 2010, "CH4", 2.0)], "region string, year int, ghg string, value double")
    a.write.parquet(f"{root}/query=emissions/scenario=01")
    b.write.parquet(f"{root}/query=emissions/scenario=1")
    t = Project.from_parquet(spark, root, [2010], names=["emissions"]).table("emissions")
    assert sorted((r.Scenario, r.ghg or "", r.value) for r in t.collect()) == [("01", "", 1.0), ("1", "CH4", 2.0)]


def test_ingest_compares_names_as_text_and_adds_all_tables(spark, tmp_path):
    root, schema = str(tmp_path / "p"), "scenario string, region string, year int, value double"
    one = spark.createDataFrame([("01", "r", 2010, 1.0)], schema)
    assert ingest_no_clobber(spark, one, root, "gdp") == ["01"]
    more = spark.createDataFrame([("1", "r", 2010, 2.0), ("SSP1", "r", 2010, 3.0), ("01", "r", 2010, 9.0)], schema)
    assert sorted(ingest_no_clobber(spark, more, root, "gdp")) == ["1", "SSP1"]
    added = ingest_project(spark, {"gdp": more, "population": more}, root)  # goes on where a stopped run ended
    assert added["gdp"] == [] and sorted(added["population"]) == ["01", "1", "SSP1"]
    t = Project.from_parquet(spark, root, [2010], names=["gdp"]).table("gdp")
    assert sorted((r.Scenario, r.value) for r in t.collect()) == [("01", 1.0), ("1", 2.0), ("SSP1", 3.0)]


def test_studies_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.0), ("N", 2.0)], "Scenario string, Value double")
    st = study_table(spark, {"main": ["A", "N"], "alt": ["N"]})
    got = sorted((r.study, r.Scenario) for r in study_subset(df, st).collect())
    assert got == [("alt", "N"), ("main", "A"), ("main", "N")]
    out = write_studies(df, st, str(tmp_path / "studies"), run_date=dt.date(2020, 1, 2), fmt="parquet")
    assert out.endswith("run_date=02Jan2020")
    assert spark.read.parquet(out).filter(F.col("study") == "alt").count() == 1
    one = write_studies(df.repartition(4), st, str(tmp_path / "one"), run_date=dt.date(2020, 1, 2),
                        one_file_per_study=True)
    for study in ("main", "alt"):
        parts = [f for f in os.listdir(os.path.join(one, f"study={study}")) if f.endswith(".csv")]
        assert len(parts) == 1


def test_numeric_looking_scenarios_stay_text(spark, tmp_path):
    root = str(tmp_path / "proj3")
    df = spark.createDataFrame([("01", "r", 2010, 1.0), ("2", "r", 2010, 2.0)],
                               "scenario string, region string, year int, value double")
    df.write.partitionBy("scenario").parquet(f"{root}/query=gdp")
    t = Project.from_parquet(spark, root, [2010], names=["gdp"]).table("gdp")
    assert dict(t.dtypes)["Scenario"] == "string"
    assert sorted(r.Scenario for r in t.collect()) == ["01", "2"]
