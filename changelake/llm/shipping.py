"""The package on the executors: shipped once per application."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, wherever the driver found it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)
