"""Makes this package importable in the Python workers of a cluster."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the executors, once for each Spark application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="quire-ship-")) / "quire.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(here.rglob("*.py")):
            out.write(source, source.relative_to(here.parent).as_posix())
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
