"""Make this package importable in the executors' Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        root = Path(__file__).resolve().parents[2]
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-')}/quarry_package", "zip", root, "quarry"))
