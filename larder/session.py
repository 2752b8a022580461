"""Session helpers shared by the entry points."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent


def local_session(cpus: str = "*", partitions: int = 8, memory: str = "8g", name: str = "larder") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors.

    Nothing is sent where the cluster's PYTHONPATH has the package already; else
    the package goes along once per application as a zip.
    """
    if str(ROOT.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    sc = spark.sparkContext
    if getattr(sc, "_larder_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="larder-")) / "larder.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(ROOT.rglob("*.py")):
            z.write(f, f.relative_to(ROOT.parent))
    sc.addPyFile(str(target))
    sc._larder_shipped = True
