"""What Python workers need to import this package, and how they keep their memory bounded."""

from __future__ import annotations

import ctypes
import os

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of rows that a Python worker is sent at once, about. Spark's own bound counts rows, and texts are long.
BATCH_BYTES = 4 << 20


def give_back() -> None:
    """Returns to the system what this process has freed. Python workers are kept for later tasks, and what they hold counts as their executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def importable() -> None:
    """Python workers of the active session import this package from where the driver has it (a cluster installs it or ships it with --py-files), and get batches of bounded size."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
