"""Makes this package importable in the Python workers of any cluster."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ensure_shipped(spark: SparkSession | None = None) -> None:
    """Sends the package to the executors once for each application; called wherever a plan gets a Python function.

    Spark's own file server carries the archive, so it works where driver and executors share no folder.
    """
    sc = (spark or SparkSession.active()).sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("lograil", os.path.relpath(path, root)))
    place = tempfile.mkdtemp(prefix="lograil-ship-")
    path = os.path.join(place, "lograil_pkg.zip")
    with open(path, "wb") as f:
        f.write(buffer.getvalue())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
