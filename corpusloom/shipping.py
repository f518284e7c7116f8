"""Sends this package to the Python workers of a session, for clusters where it isn't installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application: a zip of the package's modules goes to all workers."""
    app = spark.sparkContext.applicationId
    if app in _DONE:
        return
    home = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="ship-")) / "corpusloom_modules.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for f in sorted(home.rglob("*.py")):
            out.write(f, f.relative_to(home.parent))
    spark.sparkContext.addPyFile(str(path))
    _DONE.add(app)
