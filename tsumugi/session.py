"""Sessions, and the package on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(name: str = "tsumugi", cpus: str | int = "*", memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """A local session with adaptive plans and UTC; on a cluster, pass a session of your own to the operators instead."""
    builder = SparkSession.builder.appName(name).master(f"local[{cpus}]").config("spark.driver.memory", memory)
    for key, value in {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": str(partitions or os.cpu_count() or 8)}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once for each application, so that nothing has to be installed there."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        archive = os.path.join(tempfile.mkdtemp(), f"{root.name}.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark
