"""Make this package importable in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import perilgrid


def ship_package(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once for each context."""
    context = spark.sparkContext
    if getattr(context, "_perilgrid_shipped", None):
        return
    top = os.path.dirname(os.path.abspath(perilgrid.__file__))
    folder = tempfile.TemporaryDirectory()  # kept as long as the context, which serves the file
    path = os.path.join(folder.name, "perilgrid.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for base, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(base, name)
                archive.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    context._perilgrid_shipped = folder
