"""A folder of any file system that Hadoop knows: small files replaced whole, names, removal."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder shared by all who work on it; ``path`` may carry a scheme."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def make(self, name: str = "") -> None:
        self._fs.mkdirs(self._at(name))

    def read(self, name: str) -> str | None:
        """Text of a small file; None if there is none."""
        if not self.exists(name):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Writes a small file whole; readers see the old one or the new one."""
        staged = f"{name}.{uuid.uuid4().hex}"
        out = self._fs.create(self._at(staged))
        out.write(bytearray(text.encode()))
        out.close()
        self.move(staged, name)

    def move(self, name: str, to: str) -> None:
        """Renames, over what stands there, in one step."""
        how = self._gateway.new_array(self._hadoop.Options.Rename, 1)
        how[0] = self._hadoop.Options.Rename.OVERWRITE
        self._hadoop.FileContext.getFileContext(self._at("").toUri(), self._conf).rename(self._at(name), self._at(to), how)

    def names(self, name: str = "", folders: bool = False) -> list[str]:
        """Names in the folder or a folder of it, in order; of folders only if wanted."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)) if s.isDirectory() or not folders)

    def remove(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)
