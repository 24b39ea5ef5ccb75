"""Makes the package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, as Spark sends any Python file."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="spark-"), "affilspark_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("affilspark", os.path.relpath(path, here)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)
