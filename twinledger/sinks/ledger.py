"""The ledger of a run: which of its pairs are done, so that a rerun goes on behind them."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from twinledger.model import DatasetError


class Folder:
    """A folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._new(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def has(self, name: str) -> bool:
        return self._fs.exists(self._new(self.at(name)))

    def names(self, name: str) -> list[str]:
        return [f.getPath().getName() for f in self._fs.listStatus(self._new(self.at(name)))]

    def move(self, name: str, to: str) -> None:
        """One rename: on a file system whose renames are atomic the new name is there as a whole or not at all."""
        if not self._fs.rename(self._new(self.at(name)), self._new(self.at(to))):
            raise DatasetError("LEDGER", f"cannot rename {self.at(name)} to {to}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._new(self.at(name)), True)

    def mark(self, name: str) -> None:
        self._fs.create(self._new(self.at(name)), True).close()


class Ledger:
    """Reports of the pairs of one run, each committed by a rename.

    The run is named by the caller: a rerun under the same name skips
    the pairs that it finds committed, another name starts anew. A pair is known by its place and its
    row of the manifest, so a changed row is validated again. One process may work on a run at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, run: str):
        if not run or "/" in run:
            raise DatasetError("BAD_CONFIG", f"a run needs a name without a slash, got {run!r}")
        self.spark, self.run = spark, run
        self.folder = Folder(spark, f"{folder.rstrip('/')}/{run}")

    def name(self, place: int, row: dict) -> str:
        digest = hashlib.sha256(json.dumps(row, sort_keys=True, default=str).encode()).hexdigest()[:16]
        return f"pair-{place:06d}-{digest}"

    def committed(self, name: str) -> bool:
        return self.folder.has(name)

    def commit(self, name: str, rows: DataFrame) -> None:
        work = f"_work-{uuid.uuid4().hex}"
        rows.write.parquet(self.folder.at(work))
        self.folder.move(work, name)

    def rows(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.folder.at(name))

    def handed_over(self, name: str) -> bool:
        return self.folder.has(f"{name}.done")

    def hand_over(self, name: str) -> None:
        self.folder.mark(f"{name}.done")


def append_once(rows: DataFrame, path: str, name: str, kind: str, options: dict) -> None:
    """One file of the folder ``path`` that carries ``name``: written beside it, then renamed; left alone if it is there already."""
    folder, suffix = Folder(rows.sparkSession, path), kind.lower()
    if folder.has(f"part-{name}.{suffix}"):
        return
    work = f"_work-{uuid.uuid4().hex}"
    rows.coalesce(1).write.options(**options).format(suffix).save(folder.at(work))
    try:
        part = next(n for n in folder.names(work) if n.startswith("part-"))
        folder.move(f"{work}/{part}", f"part-{name}.{suffix}")
    finally:
        folder.remove(work)
