"""Gives the executors' Python this package, as ``--py-files`` would."""

from __future__ import annotations

import os
import shutil

from pyspark import SparkFiles
from pyspark.sql import SparkSession

import dimkeeper

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application; Spark serves the archive to its executors."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    home = os.path.dirname(os.path.abspath(dimkeeper.__file__))
    folder = os.path.join(SparkFiles.getRootDirectory(), "archive")  # Spark's own, gone with the application
    archive = shutil.make_archive(os.path.join(folder, "dimkeeper_code"), "zip", os.path.dirname(home), os.path.basename(home))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
