"""Session settings shared by the bench, the tests and interactive use."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers of a cluster, once for each application; local workers import it from here."""
    context = spark.sparkContext
    if context.master.startswith("local") or context.applicationId in _shipped:
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="siteweave-")) / "siteweave.zip"  # on the driver, which serves it
    with zipfile.ZipFile(archive, "w") as out:
        for path in here.rglob("*.py"):
            out.write(path, path.relative_to(here.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "siteweave") -> SparkSession:
    """A local session with adaptive execution; a cluster brings its own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SITEWEAVE_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
