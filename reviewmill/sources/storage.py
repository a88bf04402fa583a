"""Small files and moves in the store that Spark reads, through its own file system classes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


class Store:
    """The file system that holds a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self.root = self._path(path)
        self.files = self.root.getFileSystem(spark._jsc.hadoopConfiguration())
        self.name = self.files.makeQualified(self.root).toString()

    def exists(self, path: str) -> bool:
        return self.files.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """Names of what lies in a folder, in order; none if there is no folder."""
        at = self._path(folder)
        if not self.files.exists(at):
            return []
        return sorted(status.getPath().getName() for status in self.files.listStatus(at))

    def walk(self, folder: str) -> list[str]:
        """Data files below a folder, as paths relative to it; hidden files and folders are left out."""
        at = self.files.makeQualified(self._path(folder)).toString().rstrip("/")
        if not self.files.exists(self._path(folder)):
            return []
        found, listed = [], self.files.listFiles(self._path(folder), True)
        while listed.hasNext():
            name = listed.next().getPath().toString()[len(at) + 1 :]
            if not any(part.startswith((".", "_")) and "=" not in part for part in name.split("/")):
                found.append(name)
        return sorted(found)

    def read(self, path: str) -> str:
        stream = self.files.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Write a new file; raises if it is there already, so that of two writers one fails."""
        out = self.files.create(self._path(path), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def move(self, source: str, target: str) -> None:
        """Move a file; done already if it is only at the target, so a move can be repeated."""
        if not self.exists(source) and self.exists(target):
            return
        at = self._path(target)
        self.files.mkdirs(at.getParent())
        if not self.files.rename(self._path(source), at):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, paths: Iterable[str]) -> None:
        for path in paths:
            self.files.delete(self._path(path), True)
