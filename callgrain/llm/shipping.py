"""The package on executors, for sessions that were started without it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import callgrain


def ship(spark: SparkSession) -> None:
    """Add the package's files to the session, as `spark-submit --py-files` does; once for each Spark application.

    Spark itself sends the archive to the executors. Users who submit the package with their application need not call this.
    """
    context = spark.sparkContext
    if getattr(context, "_callgrain_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(callgrain.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="callgrain-"), "callgrain.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.join("callgrain", os.path.relpath(file, root)))
    context.addPyFile(path)
    context._callgrain_shipped = True
