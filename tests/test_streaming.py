"""Streaming ingest: new scenarios are appended, stored ones are left alone."""

from pyspark.sql import types as T

from panelrep.sources.facts import Project
from panelrep.streaming.ingest import clear, drain, publish, start_ingest

SCHEMA = T.StructType([T.StructField("scenario", T.StringType()), T.StructField("region", T.StringType()),
                       T.StructField("year", T.IntegerType()), T.StructField("value", T.DoubleType())])


def test_stream_ingest_no_clobber(spark, tmp_path):
    root = str(tmp_path / "project")
    spark.createDataFrame([("N", "r", 2010, 1.0)], SCHEMA).write.partitionBy("scenario").parquet(
        f"{root}/query=population")
    src = str(tmp_path / "exports")
    spark.createDataFrame([("A", "r", 2010, 5.0), ("N", "r", 2010, 9.0)], SCHEMA).write.parquet(f"{src}/batch1")
    ck = str(tmp_path / "ck")
    assert drain(spark, f"{src}/batch1", SCHEMA, root, "population", checkpoint=ck) == ["A"]
    # a second run sees no new files and adds nothing
    assert drain(spark, f"{src}/batch1", SCHEMA, root, "population", checkpoint=ck) == []
    proj = Project.from_parquet(spark, root, [2010], names=["population"])
    got = sorted((r.Scenario, r.value) for r in proj.table("population").collect())
    assert got == [("A", 5.0), ("N", 1.0)]
    clear(spark, root, "population")
    assert publish(spark, SCHEMA, root, "population") == []


def test_scenario_in_several_batches_is_stored_whole(spark, tmp_path):
    root, src = str(tmp_path / "project"), str(tmp_path / "exports")
    for k in range(3):
        spark.createDataFrame([("A", f"r{k}", 2010, float(k)), ("B", f"r{k}", 2010, 1.0)], SCHEMA).coalesce(1) \
            .write.mode("append").parquet(src)
    q = start_ingest(spark, src, SCHEMA, root, "gdp", checkpoint=str(tmp_path / "ck"), files_per_batch=1)
    q.awaitTermination(120)
    assert publish(spark, SCHEMA, root, "gdp", ["A"]) == ["A"]
    assert publish(spark, SCHEMA, root, "gdp") == ["B"]
    proj = Project.from_parquet(spark, root, [2010], names=["gdp"])
    got = sorted((r.Scenario, r.region) for r in proj.table("gdp").collect())
    assert got == [(s, f"r{k}") for s in "AB" for k in range(3)]
