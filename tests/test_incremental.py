"""Reports brought up to date, ordered CSV files."""

import glob

import pytest
from pyspark.sql import functions as F

from panelrep.plans import catalog
from panelrep.plans.incremental import read_updated, table_name, update_report
from panelrep.plans.report import build_indicators, final_template
from panelrep.sources import store
from panelrep.sources.facts import Project, write_project
from panelrep.sources.sinks import joined_lines, write_ordered_csv

CODES = ("POPT", "XPRP", "YEXO", "IMPO", "ECH4", "CTAX", "FEED_ALLOC", "PROD")


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


def shifted(spark, S, names):
    """The stand-in tables with the years of scenario N two later, so that scenarios start apart."""
    late = F.when(F.col("scenario") == "N", 2).otherwise(0)
    return {n: S.project.raw(n).withColumn("year", F.col("year") + late) for n in names}


@pytest.fixture(scope="module")
def project(spark, sf_small, tmp_path_factory):
    S = catalog.stand_in(spark, sf_small)
    names = [n for n in catalog.standin.QUERY_NAMES if n != "pop_qty"]
    tables = shifted(spark, S, names)
    root = str(tmp_path_factory.mktemp("facts"))
    for scenario in ("N", "R"):
        write_project({n: df.filter(F.col("scenario") == scenario) for n, df in tables.items()}, root)
    return S, root, {n: df.filter(F.col("scenario") == "A") for n, df in tables.items()}


@pytest.mark.parametrize("per_scenario", [False, True])
def test_update_equals_a_full_run_and_reads_new_scenarios_only(spark, project, tmp_path, per_scenario):
    S, root, last = project
    cfg, report = S.cfg.with_(per_scenario_base=per_scenario), str(tmp_path / "report")
    update_report(spark, root, S.br, cfg, report, ["N"], CODES)
    first = read_updated(spark, root, S.br, cfg, report, CODES)
    assert {r.Scenario for r in first.select("Scenario").distinct().collect()} == {"N"}
    added = update_report(spark, root, S.br, cfg, report, codes=CODES)
    assert added["POPT"] in (["R"], ["R", "A"])
    assert not any(update_report(spark, root, S.br, cfg, report, codes=CODES).values())
    if "A" not in store.snapshot(spark, root).scenarios("population"):
        write_project(last, root)
    moved = update_report(spark, root, S.br, cfg, report, codes=CODES)
    p = Project.from_parquet(spark, root, cfg.years)
    built = build_indicators(p, S.br, cfg)
    full = final_template({k: built[k] for k in CODES})
    assert rows(read_updated(spark, root, S.br, cfg, report, CODES)) == rows(full)
    assert all(s in (["A"], []) for name, s in moved.items() if not name.startswith(("XPRP", "YEXO")))


def test_base_year_is_part_of_the_table_name(project):
    S, _, _ = project
    first = {"ag_prod": {"N": 1997}, "an_prod": {"N": 1999, "A": 1995}, "harvests": {}}
    assert table_name("XPRP", first, S.cfg) == "XPRP-1997-1995" and table_name("YEXO", first, S.cfg) == "YEXO-None"
    assert table_name("XPRP", first, S.cfg.with_(per_scenario_base=True)) == "XPRP-own"
    assert table_name("POPT", first, S.cfg) == "POPT"


def test_files_of_reported_scenarios_are_not_read_again(spark, project, tmp_path):
    S, root, _ = project
    own, report = str(tmp_path / "facts"), str(tmp_path / "report")
    tables = {n: Project.from_parquet(spark, root, S.cfg.years, names=[n]).raw(n) for n in catalog.standin.QUERY_NAMES
              if n != "pop_qty"}
    write_project({n: df.filter("scenario = 'N'") for n, df in tables.items()}, own)
    update_report(spark, own, S.br, S.cfg, report, codes=("POPT", "IMPO", "PROD"))
    before = rows(read_updated(spark, own, S.br, S.cfg, report, ("POPT", "IMPO", "PROD")))
    for path in glob.glob(f"{own}/query=*/**/*.parquet", recursive=True):
        with open(path, "wb") as f:
            f.write(b"gone")
    write_project({n: df.filter("scenario = 'R'") for n, df in tables.items()}, own)
    added = update_report(spark, own, S.br, S.cfg, report, codes=("POPT", "IMPO", "PROD"))
    assert added == {"POPT": ["R"], "IMPO": ["R"], "PROD": ["R"]}
    assert set(before) < set(rows(read_updated(spark, own, S.br, S.cfg, report, ("POPT", "IMPO", "PROD"))))


def test_ordered_csv_is_one_file_in_parts(spark, tmp_path):
    schema = "Item string, Year int, Value double"
    data = [(f"i{k % 50:02d}" if k % 7 else None, 2000 + k % 9, float(k) if k % 5 else None) for k in range(4000)]
    data += [("i01", 2000, 0.5)] * 3
    for n in (1, 6):
        path = str(tmp_path / f"csv{n}")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            write_ordered_csv(spark.createDataFrame(data, schema).repartition(n), path, ["Item", -F.col("Year")])
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        parts = sorted(glob.glob(f"{path}/part-*"))
        text = "".join(open(p).read() for p in parts)
        assert len(parts) > 1 and text.count('"Item"') == 1 and text.startswith('"Item","Year","Value"\n')
        lines = text.splitlines()
        body = [tuple(x.split(",")) for x in lines[1:]]
        assert len(body) == len(data)
        assert [(i == "NA", i) for i, *_ in body] == sorted((i == "NA", i) for i, *_ in body)
        assert [r.line for r in joined_lines(spark, path).orderBy("line_no").collect()] == lines
        assert [r.line_no for r in joined_lines(spark, path).orderBy("line_no").collect()] == list(range(1, len(lines) + 1))


def test_ordered_csv_does_not_depend_on_partitions(spark, tmp_path):
    df = spark.range(500).selectExpr("concat('k', id % 13) Item", "cast(id as double) / 3 Value")
    texts = set()
    for n in (1, 5):
        write_ordered_csv(df.repartition(n), str(tmp_path / str(n)), ["Item"])
        texts.add("".join(open(p).read() for p in sorted(glob.glob(f"{tmp_path}/{n}/part-*"))))
    assert len(texts) == 1
