"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths of the tables written within each :func:`settled` that runs now.
_WRITTEN: ContextVar[tuple[list[str], ...]] = ContextVar("_WRITTEN", default=())


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where none is set, as in local tests, a
    temporary folder, which a cluster's executors could not read and is refused there."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="spark-shared-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        folder = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut, and no executor's loss loses it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    for paths in _WRITTEN.get():
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the session's file systems."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, written; the tables that it kept on its way are deleted."""
    written: list[str] = []
    token = _WRITTEN.set((*_WRITTEN.get(), written))
    try:
        result = keep(make())
    finally:
        _WRITTEN.reset(token)
    for path in written[:-1]:
        delete(result.sparkSession, path)
    return result
