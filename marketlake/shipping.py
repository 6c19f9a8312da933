"""Makes this package importable in Python workers that do not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the executors, once an application."""
    sc = spark.sparkContext
    if sc.applicationId in _DONE:
        return
    root = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp()) / "marketlake_src.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(out))
    _DONE.add(sc.applicationId)
