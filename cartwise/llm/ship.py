"""Makes this package importable in the Python workers of a cluster."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import cartwise

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package once to the workers of the session, as ``--py-files`` would.

    Batch functions refer to their modules by name, so what they keep (tables made from a
    broadcast model, a tokenizer) stays in the worker from one task to the next.
    """
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = Path(cartwise.__file__).parent
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    path = os.path.join(tempfile.mkdtemp(), "cartwise_package.zip")
    Path(path).write_bytes(body.getvalue())
    context.addPyFile(path)
    _sent.add(context.applicationId)
