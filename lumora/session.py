"""Make this package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors once per application.

    Not needed where it is installed on every node or passed with ``--py-files``.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="lumora-"), "lumora.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, files in os.walk(root):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
        _shipped.add(sc.applicationId)
    return spark
