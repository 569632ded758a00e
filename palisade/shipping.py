"""Makes this package importable in Spark's Python workers, wherever the driver was started."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's sources to the session's files, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    handle, name = tempfile.mkstemp(prefix="palisade-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(name, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, f"{root.name}/{path.relative_to(root)}")
    context.addPyFile(name)
    _shipped.add(context.applicationId)
