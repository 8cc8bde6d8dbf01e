"""What the store asks of a file system; any that Hadoop knows will do."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder of a file system, addressed by names below it."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _at(self, name: str):
        return self._path(self.path(name))

    def exists(self, name: str) -> bool:
        return self._system.exists(self._at(name))

    def names(self, name: str) -> list[str]:
        """What lies in a folder; nothing if there is none."""
        if not self.exists(name):
            return []
        return [status.getPath().getName() for status in self._system.listStatus(self._at(name))]

    def modified(self, name: str) -> float:
        """Seconds since the epoch."""
        return self._system.getFileStatus(self._at(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self._system.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8", "replace")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Write a small file if there is none of that name; whether it was written.
        Of several writers one succeeds: HDFS creates exclusively, and object
        stores are asked for a conditional put. A local folder checks and creates."""
        builder = self._system.createFile(self._at(name)).overwrite(False).recursive()
        try:
            stream = builder.opt("fs.option.create.conditional.overwrite", "true").build()
            stream.write(bytearray(text.encode()))
            stream.close()
        except Py4JJavaError as error:
            if self.exists(name) and "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self._system.delete(self._at(name), True)
