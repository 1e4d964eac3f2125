"""Small files and folders in any store that Spark reaches, from the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder of a Hadoop file system; names are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str = "") -> list[str]:
        """Names of the entries of a folder; none if it is not there."""
        path = self._path(name)
        if not self._fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(path))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file that appears whole; False if there is one of that name already."""
        parent, _, last = name.rpartition("/")
        self._fs.mkdirs(self._path(parent))
        hidden = f"{parent}/.{last}-{uuid.uuid4().hex}".lstrip("/")
        stream = self._fs.create(self._path(hidden), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        fs = self._jvm.org.apache.hadoop.fs
        none = self._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        context = fs.FileContext.getFileContext(self._path("").toUri(), self._conf)
        try:
            context.rename(self._path(hidden), self._path(name), none)
        except Exception as failure:
            self._fs.delete(self._path(hidden), False)
            if "FileAlreadyExists" in str(failure):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
