"""Tables in the cluster's shared folder, and what Python workers need to import this package."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..workers import BATCH_BYTES, give_back

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a temporary folder is made, on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="corpusmill-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return _OWN[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Paths of the tables staged within each open ``scratch``, the innermost last.
_OPEN: list[list[tuple[SparkSession, str]]] = []


#: Where true, Spark deletes the shuffle files of a query as it ends; else when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows as Parquet to the shared folder and reads them again: lineage ends there, lost executors lose nothing, and no shuffle file of it stays."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if _OPEN:
        _OPEN[-1].append((spark, path))
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    found = spark.read.schema(df.schema).parquet(path)
    found.staged_path = path
    return found


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def dropped(df: DataFrame) -> None:
    """Deletes a staged table that no later plan reads."""
    path = getattr(df, "staged_path", None)
    if path:
        _delete(df.sparkSession, path)


class scratch:
    """Within it, staged tables are scratch: at its end, by an error too, all are deleted but those given to ``keep``, which pass to the scratch around it."""

    def __enter__(self) -> scratch:
        self._kept: set[str] = set()
        _OPEN.append([])
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self._kept.add(df.staged_path)
        return df

    def __exit__(self, *error) -> None:
        own = _OPEN.pop()
        for spark, path in own:
            if path not in self._kept or error[0] is not None:
                _delete(spark, path)
            elif _OPEN:
                _OPEN[-1].append((spark, path))


def unused(columns: list[str], name: str) -> str:
    """``name`` behind as many underscores as no column's name, in capitals or not, begins with."""
    while any(c.lower().startswith(name.lower()) for c in columns):
        name = "_" + name
    return name


def importable(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it (a cluster ships it with --py-files), and get batches of bounded size."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, a function for mapInArrow, whose worker gives back at the end of each task what it has freed."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
