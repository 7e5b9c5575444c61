"""The package on the workers, where they can't import it by themselves."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import quarrymill


def ship(spark: SparkSession) -> None:
    """Sends the package to the workers, once for each application, unless the working folder or PYTHONPATH has it."""
    sc, root = spark.sparkContext, Path(quarrymill.__file__).resolve().parent
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if getattr(sc, "_quarrymill_shipped", False) or any(p and Path(p).resolve() == root.parent for p in known):
        return
    archive = Path(tempfile.mkdtemp()) / "quarrymill.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._quarrymill_shipped = True
