"""Making this package importable by the Python workers of a cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors, once per application; Spark copies it to those that join later too."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        folder = tempfile.mkdtemp(prefix="chatmill-ship-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)  # executors that join later fetch it until then
        archive = shutil.make_archive(str(Path(folder) / _PACKAGE.name), "zip", root_dir=_PACKAGE.parent, base_dir=_PACKAGE.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark
