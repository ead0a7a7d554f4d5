"""Python workers get the package from the driver, wherever the session was started from."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add this package to the application's Python files, once; a package that came as one already stays as it is."""
    context = spark.sparkContext
    root = Path(__file__).resolve().parent.parent
    if context.applicationId in _shipped or not root.is_dir():
        return
    folder = tempfile.mkdtemp(prefix="tabulith-")  # of code, on the driver, which serves it; it goes when the driver ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    bundle = Path(folder) / "tabulith-package.zip"
    with zipfile.ZipFile(bundle, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(bundle))
    _shipped.add(context.applicationId)
