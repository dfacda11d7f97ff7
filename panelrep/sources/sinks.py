"""Sinks: study subsets and the template CSV/Parquet outputs."""

from __future__ import annotations

import datetime as _dt
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bounded import Small, local_table, prove_bound


def study_table(spark: SparkSession, studies: Mapping[str, Sequence[str]]) -> Small:
    """``(study, scenario)`` rows from named scenario lists."""
    rows = [(s, sc) for s, scs in studies.items() for sc in scs]
    schema = T.StructType([T.StructField("study", T.StringType()), T.StructField("scenario", T.StringType())])
    return prove_bound(local_table(spark, rows, schema))


def study_subset(df: DataFrame, studies: Small, scenario: str = "Scenario") -> DataFrame:
    """Template rows tagged with every study whose list holds their scenario.

    One pass for all studies.
    """
    s = studies.side() if studies.bounded else studies.df
    s = s.select(F.col("study"), F.col("scenario").alias("__study_scenario"))
    return df.join(s, df[scenario] == s["__study_scenario"], "inner").drop("__study_scenario")


def csv_line(df: DataFrame) -> Column:
    """A row as a CSV line in the reporting workflow's form.

    Text is in quotes (line breaks become spaces), null is ``NA``, infinities are ``Inf`` and ``-Inf``.
    """
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "string":
            text = F.concat(F.lit('"'), F.replace(F.translate(c, "\r\n", "  "), F.lit('"'), F.lit('""')), F.lit('"'))
        elif kind in ("double", "float"):
            text = F.when(c == float("inf"), "Inf").when(c == float("-inf"), "-Inf").otherwise(c.cast("string"))
        else:
            text = c.cast("string")
        out.append(F.coalesce(text, F.lit("NA")))
    return F.concat_ws(",", *out)


def csv_header(df: DataFrame) -> str:
    return ",".join(f'"{n}"' for n in df.columns)


def csv_lines(df: DataFrame) -> DataFrame:
    """One column, named by the header, of CSV lines as :func:`csv_line` makes them."""
    return df.select(csv_line(df).alias(csv_header(df)))


def write_template_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """CSV with header, its lines those of :func:`csv_lines`."""
    # the lines are complete: with a separator that no line has, the writer adds nothing but the header
    csv_lines(df).write.mode(mode).option("header", True).option("sep", "\u0001").option("quote", "").csv(path)


def write_ordered_csv(df: DataFrame, path: str, order: Sequence[str | Column], *, mode: str = "overwrite") -> None:
    """A CSV in ascending ``order`` of columns or expressions (nulls last), dealt over parts that give the whole file when joined by name.

    The header is the first line of the first part only.  Rows are partitioned
    by ranges of the order, so no task holds them all; rows that are equal in
    it come by their line, so that the text does not depend on partitions.
    """
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    body = df.select(F.lit(1).alias("__part"), *[k.alias(f"__o{i}") for i, k in enumerate(keys)],
                     csv_line(df).alias("value"))
    head = local_table(df.sparkSession, [(0, csv_header(df))], "__part int, value string")
    by = [F.col(c).asc_nulls_last() for c in body.columns]
    head.unionByName(body, allowMissingColumns=True).select(*body.columns) \
        .repartitionByRange(*by).sortWithinPartitions(*by).select("value").write.mode(mode).text(path)


def joined_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of the text that the parts below ``path`` give when joined by name; each part is read whole."""
    parts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("part"), F.split(
        F.expr("substring(value, 1, length(value) - 1)"), "\n").alias("lines"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    at = parts.select("part", F.size("lines").alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return parts.join(at, "part").select("before", F.posexplode("lines").alias("k", "line")) \
        .select((F.col("before") + F.col("k") + 1).alias("line_no"), "line")


def write_studies(df: DataFrame, studies: Small, root: str, prefixes: Mapping[str, str] | None = None,
                  run_date: _dt.date | None = None, fmt: str = "csv", one_file_per_study: bool = False) -> str:
    """Write every study subset to its own folder ``study=<name>``, replacing that study only.

    The run date is an argument (default: today) so that reruns are
    reproducible; it becomes a path component ``run_date=<ddMonYYYY>``.  Other
    studies of the day stay as they are.  ``one_file_per_study`` writes each
    study as a single file, by one task: only for the aggregated template,
    whose size is scenarios x regions x items x years, never for fact tables.
    """
    stamp = (run_date or _dt.date.today()).strftime("%d%b%Y")
    out = f"{root}/run_date={stamp}"
    tagged = study_subset(df, studies)
    for row in studies.df.select("study").distinct().collect():  # the few names given by the caller
        part = tagged.filter(F.col("study") == row.study).drop("study")
        part = part.coalesce(1) if one_file_per_study else part
        path = f"{out}/study={(prefixes or {}).get(row.study, row.study)}"
        if fmt == "csv":
            write_template_csv(part, path)
        else:
            part.write.mode("overwrite").parquet(path)
    return out
