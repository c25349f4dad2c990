"""Send this package to the Python workers of a session that was started without it."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parents[2]
_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once, as ``--py-files`` would.

    Nothing is done where the package is on the path of the workers already.
    """
    context = spark.sparkContext
    on_path = str(_ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if on_path or context.getConf().get("spark.submit.pyFiles", "") or context.applicationId in _sent:
        return
    archive = os.path.join(tempfile.mkdtemp(), "gaugeflow")
    context.addPyFile(shutil.make_archive(archive, "zip", _ROOT, "gaugeflow"))
    _sent.add(context.applicationId)
