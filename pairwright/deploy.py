"""Getting this package to the executors when it was not installed or passed with `--py-files`."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="pairwright-")) / package.name
        context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
