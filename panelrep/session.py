"""Spark session defaults for the reporting jobs."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # reports run many small independent jobs side by side (one per indicator)
    "spark.scheduler.mode": "FAIR",
    # Python call-site capture costs several JVM round trips per Column call;
    # plans of a full report are built from thousands of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Get or create a session with AQE on and a UTC clock.

    On a cluster the master and the checkpoint folder come from the cluster
    configuration; only when ``spark.checkpoint.dir`` is unset (local tests)
    a scratch folder is chosen.
    """
    b = SparkSession.builder
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **conf}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


_SCRATCH: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``, or the one the context already has.

    Only a ``local`` master, where all tasks share the machine, gets a scratch
    folder of its own when neither is set (one per process, so that sessions
    made one after another find each other's written tables).  Elsewhere an
    unset folder is an error: executors must all see what is written there.
    """
    global _SCRATCH
    sc = spark.sparkContext
    named, current = spark.conf.get("spark.checkpoint.dir", None), sc.getCheckpointDir()
    if not named and current:
        return current
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _SCRATCH is None:
            _SCRATCH = tempfile.mkdtemp(prefix="panelrep-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        named = _SCRATCH
        spark.conf.set("spark.checkpoint.dir", named)
    if not current or _path(spark, named).toUri().getPath().rstrip("/") not in current:
        sc.setCheckpointDir(named)
    return named


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001


def file_system(spark: SparkSession, path: str) -> tuple:
    """Hadoop's (file system, path) of a path, whatever store it is in."""
    p = _path(spark, path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p  # noqa: SLF001


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint folder, removed when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, p = file_system(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, for functions that run there in Python.

    Spark's own file distribution is used, so executors need neither the
    driver's folders nor an installed copy.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    path = os.path.join(tempfile.mkdtemp(prefix="panelrep-"), f"panelrep_{app.replace('-', '_')}.zip")
    with open(path, "wb") as f:
        f.write(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
