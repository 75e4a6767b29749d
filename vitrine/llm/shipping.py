"""Makes this package importable in the executors' Python workers, whatever their PYTHONPATH is; keeps one model a worker; frees the shuffle files of stored results."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

import vitrine

_shipped: set[str] = set()
_held: dict[str, object] = {}


def ship_package(spark: SparkSession) -> None:
    """Adds a zip of the package's sources to the application's Python files, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(vitrine.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="vitrine-package-"), "vitrine-package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("vitrine", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def worker_held(key: str, make: Callable[[], Any]) -> Any:
    """What `make` returns, kept by a Python worker until an operator asks for something else: workers outlive the stages."""
    if key not in _held:
        _held.clear()
        gc.collect()
        _held[key] = make()
    return _held[key]


def release_shuffles(spark: SparkSession) -> None:
    """Results are stored: the driver forgets the shuffles that made them, and Spark's cleaner frees their disk."""
    gc.collect()
    spark._jvm.System.gc()
