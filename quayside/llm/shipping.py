"""Makes this package importable in Python workers that don't have it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import SparkSession

import quayside


@lru_cache(maxsize=1)
def _archive() -> str:
    """The package's sources as a zip file of the driver, which Spark hands to executors."""
    root = Path(quayside.__file__).parent
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="quayside-src-")), "quayside_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    return path


def ship_package(spark: SparkSession) -> None:
    """What ``--py-files`` does, once per Spark context."""
    sc = spark.sparkContext
    if "quayside_src.zip" not in sc._python_includes:
        sc.addPyFile(_archive())
