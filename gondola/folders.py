"""Folders on whatever file system Spark is configured for."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A path; its children are names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def child(self, *names: str) -> Folder:
        return Folder(self.spark, "/".join([self.path, *names]))

    def exists(self) -> bool:
        return self._fs.exists(self._path)

    def delete(self) -> None:
        self._fs.delete(self._path, True)

    def touch(self) -> None:
        self._fs.create(self._path, True).close()

    def move_to(self, target: Folder) -> None:
        self._fs.mkdirs(target._path.getParent())
        if not self._fs.rename(self._path, target._path):
            raise OSError(f"cannot move {self.path} to {target.path}")

    def children(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path)) if self.exists() else []

    def read_text(self) -> str:
        stream = self._fs.open(self._path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, text: str) -> None:
        """A small file that appears whole: written under another name and moved. An existing one is an error."""
        draft = Folder(self.spark, f"{self.path}.{uuid.uuid4().hex}.draft")
        stream = draft._fs.create(draft._path, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if self.exists():
                raise FileExistsError(self.path)
            draft.move_to(self)
        except Exception:
            draft.delete()
            raise
