"""Folders of a lake through Hadoop's file systems, so any scheme Spark reads works here too.

Only names, small text files and renames: data always goes through Spark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The file system that holds ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def children(self, path: str) -> list[str]:
        """Names in a folder (none if it is missing), ascending."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def move(self, old: str, new: str) -> None:
        """Rename; ``new`` must not exist (else the file system might put the folder into it)."""
        if self.exists(new):
            raise FileExistsError(new)
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def read(self, path: str) -> str | None:
        """A small text file, None if it is missing."""
        if not self.exists(path):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


def sibling(path: str, suffix: str) -> str:
    """A hidden folder beside a table: ``/lake/gold/t`` -> ``/lake/gold/.t.<suffix>``."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{suffix}" if parent else f".{name}.{suffix}"
