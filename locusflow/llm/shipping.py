"""Prepares a session for the operators: the package on its executors, and batches of text of moderate size."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import locusflow

#: Rows that Spark hands to Python at once; rows here hold whole texts, and two workers share an executor's memory.
BATCH_ROWS = 1024
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's Python files to the session, once per Spark application, and bound its Arrow batches.

    The archive is made on the driver and handed to Spark, which serves it to every executor,
    also to those that join later.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows)) > BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(locusflow.__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="locusflow-py-"), "locusflow_py.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, Path("locusflow") / path.relative_to(root))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
