"""Small file-system calls made from the driver; they move names, never data."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The Hadoop file system a path lives on (local, HDFS or an object store)."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark

    def _at(self, path: str):
        target = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._spark._jsc.hadoopConfiguration()), target

    def exists(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target)

    def names(self, path: str) -> list[str]:
        fs, target = self._at(path)
        if not fs.exists(target):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(target))

    def make_dirs(self, path: str) -> None:
        fs, target = self._at(path)
        fs.mkdirs(target)

    def move(self, source: str, target: str) -> None:
        """Rename a file; an existing target is an error, so that nothing is lost silently."""
        fs, origin = self._at(source)
        _, destination = self._at(target)
        if fs.exists(destination):
            raise FileExistsError(f"{target} exists, {source} was not moved")
        if not fs.rename(origin, destination):
            raise OSError(f"could not move {source} to {target}")

    def remove(self, path: str) -> None:
        fs, target = self._at(path)
        fs.delete(target, True)
