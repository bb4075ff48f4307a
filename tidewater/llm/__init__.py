"""Operations of a training-data pipeline.

Python workers import this package by name. Where it isn't installed on them,
the folder that the driver imports it from is put on their path, for a session
that is running and for one that is started later.
"""

import os
import pathlib

from pyspark import SparkContext

_ROOT = str(pathlib.Path(__file__).resolve().parents[2])


def _joined(path: str) -> str:
    parts = [p for p in path.split(os.pathsep) if p]
    return os.pathsep.join(parts if _ROOT in parts else [*parts, _ROOT])


os.environ["PYTHONPATH"] = _joined(os.environ.get("PYTHONPATH", ""))
if (_running := SparkContext._active_spark_context) is not None:
    _running.environment["PYTHONPATH"] = _joined(_running.environment.get("PYTHONPATH", ""))
