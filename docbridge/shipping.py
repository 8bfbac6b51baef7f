"""Send this package to the executors' Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Add the package to the workers' path, once for each Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_docbridge_shipped", False):
        return
    here = Path(__file__).resolve().parent
    if not here.is_dir():  # already runs from an archive
        return
    target = Path(tempfile.mkdtemp(prefix="docbridge-")) / "docbridge.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, Path("docbridge") / p.relative_to(here))
    sc.addPyFile(str(target))
    sc._docbridge_shipped = True
