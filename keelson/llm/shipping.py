"""Makes this package importable in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import keelson

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once for each application.

    The driver's own import path is not theirs: a cluster need not have the
    package installed, nor the driver's working folder.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(keelson.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="keelson-src-"), "keelson_sources.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("keelson", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
