"""Readies a session for the operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tickmart
from tickmart.session import configure

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Sets the session options and hands the package to the Python workers
    (once an application), so they need no installation of their own."""
    configure(spark)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.abspath(tickmart.__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="tickmart-"), "tickmart.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("tickmart", os.path.relpath(full, root)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark
