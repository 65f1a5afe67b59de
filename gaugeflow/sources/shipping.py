"""The package for the Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package along with the jobs, once per application.

    Not needed where it is installed or on PYTHONPATH, from which the workers import it. Spark
    copies the file from the driver to the executors.
    """
    context = spark.sparkContext
    on_path = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if context.applicationId in _shipped or str(ROOT) in on_path or ROOT.name == "site-packages":
        return
    path = Path(tempfile.mkdtemp(prefix="package-")) / "gaugeflow.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted((ROOT / "gaugeflow").rglob("*.py")):
            archive.write(source, source.relative_to(ROOT))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)
