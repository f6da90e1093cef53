"""Makes this package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> None:
    """Send the package to the executors unless their import path has it by PYTHONPATH or the working folder."""
    paths = {os.path.abspath(p) for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p}
    context = spark.sparkContext
    if str(ROOT) in paths or getattr(context, "_lapidar_shipped", False):
        return
    packed = Path(tempfile.mkdtemp(prefix="lapidar-"), "lapidar.zip")  # executors fetch it from the driver
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted((ROOT / "lapidar").rglob("*.py")):
            z.write(p, p.relative_to(ROOT))
    context.addPyFile(str(packed))
    context._lapidar_shipped = True
