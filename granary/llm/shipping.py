"""Giving executors the source of this package, so that functions in tasks can import it."""

from __future__ import annotations

import os
import tempfile
import zipfile

import granary
from pyspark import SparkFiles
from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's source files to Spark's file server, once per application.

    The archive is built in the driver's own Spark folder and fetched from there by the executors,
    also by those that join or restart later.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(granary.__file__))
    archive = os.path.join(tempfile.mkdtemp(dir=SparkFiles.getRootDirectory()), "granary_source.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("granary", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
