"""What a Spark session needs before Python runs on its executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="barloom-code-"), "barloom.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
