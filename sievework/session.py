"""Session defaults shared by tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, app: str = "sievework", **conf: str) -> SparkSession:
    """A local session with the settings the library is developed against.

    On a cluster the caller brings its own session; nothing here is required.
    """
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Makes this package importable on the session's executors, once a session.

    The source goes out as a zip through Spark's own file server, so neither a shared
    folder nor a PYTHONPATH on the executors is needed.
    """
    context = spark.sparkContext
    if getattr(context, "_sievework_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    if root.parent.suffix != ".zip":
        target = Path(tempfile.mkdtemp(prefix="sievework-")) / "sievework.zip"
        with zipfile.ZipFile(target, "w") as z:
            for path in sorted(root.rglob("*.py")):
                z.write(path, path.relative_to(root.parent))
        context.addPyFile(str(target))
    context._sievework_shipped = True
    return spark
