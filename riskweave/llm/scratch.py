"""Tables that a job writes between its steps."""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``.

    Only a local session without the setting falls back to a temporary folder; a cluster
    without it is an error, because its executors share no local disk.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "spark-shared")


def sweep(spark: SparkSession) -> None:
    """Let Spark delete shuffle files and broadcasts that no frame needs any more.

    Its cleaner goes by what the driver has collected as garbage, which a driver with room left
    may not do while the executors' disks and memory fill.
    """
    gc.collect()
    # What is let go of after the first time, by Python's and the driver's own queues, goes the second.
    for pause in (0.5, 0):
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


class Scratch:
    """One job's folder below the shared folder.  Its tables replace lineage: a lost executor
    costs a re-read.  The folder goes with ``clear`` or when the driver's JVM ends."""

    _made: list[list[Scratch]] = []

    def __init__(self, spark: SparkSession, job: str):
        self.spark = spark
        for made in self._made:
            made.append(self)
        self.folder = f"{shared_folder(spark)}/{job}-{uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path(self.folder)
        self._fs = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.deleteOnExit(self._path)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def keep(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write a frame, in one folder for each value of ``by`` if given, and read it back."""
        writer = df.write.mode("overwrite")
        if by:
            writer = writer.partitionBy(by)
        writer.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete one table."""
        self._fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name)), True)

    def clear(self) -> None:
        self._fs.delete(self._path, True)

    @classmethod
    @contextlib.contextmanager
    def cleared(cls) -> Iterator[None]:
        """Folders made inside are deleted at the end, when what they led to is written."""
        made: list[Scratch] = []
        cls._made.append(made)
        try:
            yield
        finally:
            cls._made.remove(made)
            for scratch in made:
                scratch.clear()
