"""Sends this package to the executors, for functions that run in Python there."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package's modules to the session's Python files, once per application."""
    application = spark.sparkContext.applicationId
    if application in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for module in sorted(package.rglob("*.py")):
            target.write(module, module.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _sent.add(application)
