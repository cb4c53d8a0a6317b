"""Put this package on the Python workers' path, wherever the executors run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors once per application; Python UDFs can then import it there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="narrata-ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as packed:
        for path in sorted(root.rglob("*.py")):
            packed.write(path, path.relative_to(root.parent).as_posix())
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)
