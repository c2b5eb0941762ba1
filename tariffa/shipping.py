"""Sends this package to the workers of a session that may not have it."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds a zip of the package to the session's Python files, once, unless PYTHONPATH has its folder on every machine."""
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    sc = spark.sparkContext
    if sc.applicationId in _sent or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _sent.add(sc.applicationId)
    folder = tempfile.mkdtemp()
    for d, _, names in os.walk(package):
        for n in names:
            if n.endswith(".py"):
                to = os.path.join(folder, "in", os.path.relpath(os.path.join(d, n), root))
                os.makedirs(os.path.dirname(to), exist_ok=True)
                shutil.copyfile(os.path.join(d, n), to)
    sc.addPyFile(shutil.make_archive(os.path.join(folder, os.path.basename(package)), "zip", os.path.join(folder, "in")))
