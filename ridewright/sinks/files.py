"""Folders of any file system that Spark's Hadoop client knows: listing, markers, claims."""

from __future__ import annotations

from pyspark.sql import SparkSession

SUCCESS = "_SUCCESS"


class Folder:
    """A folder seen from the driver; only names and sizes pass through it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def complete(self, name: str = "") -> bool:
        """Whether Spark finished writing the folder; its files alone do not say so."""
        return self.exists(f"{name}/{SUCCESS}" if name else SUCCESS)

    def names(self, name: str = "") -> list[str]:
        """Names below a folder, none if it is missing; hidden ones are left out."""
        try:
            found = [s.getPath().getName() for s in self._fs.listStatus(self._at(name))]
        except Exception as error:  # missing, or removed meanwhile by a vacuum
            if "FileNotFoundException" not in str(error):
                raise
            return []
        return sorted(n for n in found if not n.startswith(("_", ".")))

    def size(self, name: str) -> int:
        return self._fs.getContentSummary(self._at(name)).getLength() if self.exists(name) else 0

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def claim(self, name: str, text: str) -> bool:
        """Create a file with this text; False if somebody was first."""
        try:
            stream = self._fs.create(self._at(name), False)
        except Exception as error:
            if "FileAlreadyExists" not in str(error) and "already exists" not in str(error):
                raise
            return False
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
