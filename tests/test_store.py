"""Stored projects: commits, snapshots, columns, base years."""

import glob
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from panelrep.operators.panel import base_year_rows
from panelrep.plans import catalog
from panelrep.sources import store
from panelrep.sources.facts import Project, ingest_no_clobber, ingest_project, read_table, write_project

SCHEMA = "scenario string, region string, year int, value double"


def table(spark, *rows):
    return spark.createDataFrame([(s, "r", y, v) for s, y, v in rows], SCHEMA)


def stored(df):
    return sorted((r.scenario or "", r.year, r.value) for r in df.collect())


def test_two_writers_of_the_same_scenario(spark, tmp_path):
    root = str(tmp_path / "p")
    slow, quick = store.Ingest(spark, root), store.Ingest(spark, root)
    slow.add("gdp", table(spark, ("A", 2010, 1.0), ("B", 2010, 2.0)))
    quick.add("gdp", table(spark, ("A", 2010, 9.0)))
    assert quick.commit() == {"gdp": ["A"]}
    assert slow.commit() == {"gdp": ["B"]}  # A has been stored meanwhile and stays as it is
    assert stored(read_table(spark, root, "gdp")) == [("A", 2010, 9.0), ("B", 2010, 2.0)]


def test_a_stop_between_tables_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "p")
    write_project({"gdp": table(spark, ("N", 2010, 1.0))}, root)
    stopped = store.Ingest(spark, root)
    stopped.add("gdp", table(spark, ("A", 2010, 5.0)))  # population was to follow
    assert stored(read_table(spark, root, "gdp")) == [("N", 2010, 1.0)]
    assert read_table(spark, root, "population") is None
    again = {"gdp": table(spark, ("A", 2010, 5.0)), "population": table(spark, ("A", 2010, 6.0))}
    assert ingest_project(spark, again, root) == {"gdp": ["A"], "population": ["A"]}
    assert stored(read_table(spark, root, "gdp")) == [("A", 2010, 5.0), ("N", 2010, 1.0)]
    assert store.vacuum(spark, root) == []  # young folders stay
    assert [os.path.basename(p) for p in store.vacuum(spark, root, 0)] == [f"commit={stopped.id}"]
    assert stored(read_table(spark, root, "gdp")) == [("A", 2010, 5.0), ("N", 2010, 1.0)]


def test_a_first_ingest_that_stops_is_no_plain_project(spark, tmp_path):
    root = str(tmp_path / "p")
    store.Ingest(spark, root).add("gdp", table(spark, ("A", 2010, 5.0)))
    assert read_table(spark, root, "gdp") is None
    assert ingest_no_clobber(spark, table(spark, ("A", 2010, 1.0)), root, "gdp") == ["A"]
    assert stored(read_table(spark, root, "gdp")) == [("A", 2010, 1.0)]


def test_commits_side_by_side_get_versions_of_their_own(spark, tmp_path, monkeypatch):
    root, schema = str(tmp_path / "p"), {"gdp": table(spark, ("A", 2010, 1.0)).schema}
    monkeypatch.setattr(store, "FULL_EVERY", 4)
    versions = []

    def one(k):
        entry = store.Entry("gdp", f"s{k}", (f"query=gdp/commit=x/scenario=s{k}/part-0.parquet",), 1, (2010,))
        versions.append(store.commit(spark, root, [entry], schema)[0])

    threads = [threading.Thread(target=one, args=(k,)) for k in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(versions) == list(range(1, 13))
    snap = store.snapshot(spark, root)
    assert snap.version == 12 and sorted(snap.scenarios("gdp")) == sorted(f"s{k}" for k in range(12))
    assert len(store.snapshot(spark, root, 5).entries) == 5  # earlier versions stay readable
    assert len(glob.glob(f"{root}/_manifest/full-*.json")) == 3


def test_reader_keeps_its_version(spark, tmp_path):
    root = str(tmp_path / "p")
    ingest_no_clobber(spark, table(spark, ("A", 2010, 1.0)), root, "gdp")
    before = Project.from_parquet(spark, root, [2010], names=["gdp"])
    ingest_no_clobber(spark, table(spark, ("B", 2010, 2.0)), root, "gdp")
    assert [r.Scenario for r in before.table("gdp").collect()] == ["A"]
    assert Project.from_parquet(spark, root, [2010], names=["gdp"], version=1).table("gdp").count() == 1
    assert Project.from_parquet(spark, root, [2010], names=["gdp"]).table("gdp").count() == 2


def test_an_incomplete_manifest_file_counts_for_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "p")
    ingest_no_clobber(spark, table(spark, ("A", 2010, 1.0)), root, "gdp")
    left = f"{root}/_manifest/v{2:012d}.json"
    with open(left, "w") as f:
        f.write('{"version": 2, "entries": [["gdp", "B"')
    os.utime(left, (time.time() - 3600, time.time() - 3600))
    assert stored(read_table(spark, root, "gdp")) == [("A", 2010, 1.0)]
    assert ingest_no_clobber(spark, table(spark, ("B", 2010, 2.0)), root, "gdp") == ["B"]
    assert store.snapshot(spark, root).version == 3


def test_load_opens_no_data_file(spark, tmp_path):
    root = str(tmp_path / "p")
    write_project({"gdp": table(spark, ("A", 2010, 1.0), ("B", 2010, 2.0))}, root)
    for path in glob.glob(f"{root}/query=gdp/**/*.parquet", recursive=True):
        with open(path, "wb") as f:
            f.write(b"no parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("load", "load")
    p = Project.from_parquet(spark, root, [2010], names=["gdp"])
    assert p.table("gdp").columns == ["region", "Year", "value", "Scenario"]
    assert not tracker.getJobIdsForGroup("load")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert Project.from_parquet(spark, root, [2010], scenarios=["B"], names=["gdp"]).raw("gdp").inputFiles()[0].count("scenario=B") == 1


def test_columns_grow_by_union(spark, tmp_path):
    root = str(tmp_path / "p")
    ingest_no_clobber(spark, spark.createDataFrame([("A", 2010, 1)], "scenario string, year int, value int"), root, "gdp")
    ingest_no_clobber(spark, spark.createDataFrame([("B", 2010, 1 << 40, "x")],
                                                   "scenario string, year int, value long, ghg string"), root, "gdp")
    got = sorted(tuple(r) for r in read_table(spark, root, "gdp").select("scenario", "value", "ghg").collect())
    assert got == [("A", 1, None), ("B", 1 << 40, "x")]
    clash = spark.createDataFrame([("C", 2010, "text")], "scenario string, year int, value string")
    with pytest.raises(ValueError, match="value"):
        ingest_no_clobber(spark, clash, root, "gdp")
    wide = spark.createDataFrame([("D", 2010)], "scenario string, year int").withColumn("value", F.lit(5).cast("int"))
    assert ingest_no_clobber(spark, wide, root, "gdp") == ["D"]


def test_odd_scenario_names_and_paths(spark, tmp_path):
    root = str(tmp_path / "a b%c")
    names = ["x y", "a/b", "50%", "q=1", "1", "01", None, "é[z]"]
    ingest_no_clobber(spark, table(spark, *[(n, 2010, float(k)) for k, n in enumerate(names)]), root, "gdp")
    assert ingest_no_clobber(spark, table(spark, *[(n, 2010, 9.0) for n in names]), root, "gdp") == []
    assert stored(read_table(spark, root, "gdp")) == sorted((n or "", 2010, float(k)) for k, n in enumerate(names))


def test_base_years_come_from_the_manifest(spark, tmp_path):
    root = str(tmp_path / "p")
    rows = [("A", 2005, 0.0), ("A", 2010, 1.0), ("A", 2020, 2.0), ("B", 2020, 3.0), ("B", 2030, 4.0), (None, 2010, 5.0)]
    write_project({"gdp": table(spark, *rows)}, root)
    p = Project.from_parquet(spark, root, [2010, 2020, 2030], names=["gdp"])
    assert p.first_years["gdp"] == {"A": 2010, "B": 2020, None: 2010}
    per = base_year_rows(p.table("gdp"), per=["Scenario"], first=p.first_years["gdp"])
    assert sorted(r.value for r in per.collect()) == [1.0, 3.0, 5.0]
    one = base_year_rows(p.table("gdp"), first=p.first_years["gdp"])
    assert sorted(r.value for r in one.collect()) == [1.0, 5.0]
    plan = per._jdf.queryExecution().executedPlan().toString()
    assert "ubquery" not in plan and "Join" not in plan and "map" not in plan.lower().replace("mapbased", "")
    # the same as computed from the facts
    for kw in ({}, {"per": ["Scenario"]}):
        a, b = (base_year_rows(p.table("gdp"), first=f, **kw) for f in (None, p.first_years["gdp"]))
        assert sorted(r.value for r in a.collect()) == sorted(r.value for r in b.collect())
    assert base_year_rows(p.table("gdp"), first={}).count() == 0


def test_price_index_reads_no_facts_for_its_base_year(spark, sf_small):
    plan = catalog.price_index(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "ubquery" not in plan.replace("SubqueryBroadcast", "")
    assert "EqualTo(year,1995)" in plan
