"""A small keyed table that is replaced as a whole, so that a reader always sees one version of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class VersionedTable:
    """Versions in folders of their own, and a pointer, a file that a rename replaces.

    A version is written in full before the pointer names it, so a reader finds the old or the new one, never a part.  A
    version that is written again takes its own folder.  The version before the current one stays, for readers that have just
    opened it and for a batch that is run again; older ones go.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def current(self, below: int | None = None) -> int | None:
        """Number of the version that the pointer names, or of the one before it where that is not below a given one."""
        path, files = self._path("current")
        if not files.exists(path):
            return None
        numbers = [int(x) for x in self.spark.read.text(str(path)).first().value.split()]
        return next((n for n in numbers if below is None or n < below), None)

    def read(self, below: int | None = None) -> DataFrame | None:
        """The current version; without one None where one below a number is asked for, else an error."""
        number = self.current(below)
        if number is None:
            if below is None:
                raise ValueError("nothing has been written yet")
            return None
        return self.spark.read.parquet(f"{self.folder}/version={number}").drop("version")

    def write(self, rows: DataFrame, number: int) -> None:
        before = self.current(below=number)
        rows.write.mode("overwrite").parquet(f"{self.folder}/version={number}")
        self._point(" ".join(str(n) for n in (number, before) if n is not None))
        oldest, files = self._path(f"version={self._older(before, number)}")
        if before is not None and files.exists(oldest):
            files.delete(oldest, True)

    def _older(self, before: int | None, number: int) -> int:
        """The highest version below the two that stay."""
        root, files = self._path("")
        found = [int(s.getPath().getName().split("=")[1]) for s in files.listStatus(root) if "=" in s.getPath().getName()]
        return max((n for n in found if before is not None and n < before), default=-1)

    def _point(self, text: str) -> None:
        """Replaces the pointer by a rename, which a file system does at once."""
        jvm = self.spark.sparkContext._jvm
        fresh, files = self._path("next")
        out = files.create(fresh, True)
        out.write(bytearray(text.encode()))
        out.close()
        target, _ = self._path("current")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        overwrite = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = overwrite
        context.rename(files.makeQualified(fresh), files.makeQualified(target), options)

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
