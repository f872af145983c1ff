"""Shared folders and reuse of intermediate frames."""

from __future__ import annotations

import gc
import tempfile
import uuid
from functools import cache

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str | None:
    """Folder that every executor sees, as the cluster names it."""
    return spark.conf.get(CHECKPOINT_DIR, None)


@cache
def _own_folder() -> tempfile.TemporaryDirectory:
    """One temporary folder for this process, gone when it ends."""
    return tempfile.TemporaryDirectory(prefix="twinledger-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder.

    Only a local session, where driver and executors are one process, may
    fall back to a temporary folder of the machine.
    """
    root = shared_dir(spark)
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        root = _own_folder().name
    return f"{root.rstrip('/')}/twinledger/{name}-{uuid.uuid4().hex}"


def free_shuffles(spark: SparkSession) -> None:
    """Give back the disk of finished jobs.

    Spark deletes shuffle files when the driver's garbage collection finds their query unused, and a
    driver with room may not collect for ``spark.cleaner.periodicGC.interval``. Where one job after
    the other shuffles all rows, this asks for it in between.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Staged:
    """A frame that several jobs read, computed once.

    With a shared folder it becomes a Parquet table there: later jobs read
    only the columns they need and a lost executor costs nothing.  Without
    one it is cached on disk and memory, and lost blocks are recomputed from
    the sources.
    """

    def __init__(self, frame: DataFrame, name: str = "stage"):
        spark = frame.sparkSession
        self._path = None
        self._cached = None
        if shared_dir(spark):
            self._path = scratch_path(spark, name)
            frame.write.parquet(self._path)
            self.frame = spark.read.parquet(self._path)
        else:
            self._cached = frame.persist(StorageLevel.MEMORY_AND_DISK)
            self.frame = self._cached

    @property
    def lazy(self) -> bool:
        """Not computed before its first reader."""
        return self._cached is not None

    def release(self) -> None:
        """Give back the space; frames derived from this one must be done."""
        if self._cached is not None:
            self._cached.unpersist()
        if self._path is not None:
            spark = self.frame.sparkSession
            jvm = spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(self._path)
            conf = spark.sparkContext._jsc.hadoopConfiguration()
            path.getFileSystem(conf).delete(path, True)
