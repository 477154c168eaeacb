"""What a session needs before the library's Python functions run on its executors."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it (on a cluster it comes with --py-files)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
