"""Files of any store that Spark can reach, through the Hadoop FileSystem of their path."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """The file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self.path(root).getFileSystem(self._conf)

    def path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def exists(self, p: str) -> bool:
        return self._fs.exists(self.path(p))

    def children(self, p: str) -> list[str]:
        """Names below a folder; none when it does not exist."""
        if not self.exists(p):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(p)))

    def files(self, p: str) -> list[str]:
        """All files below a folder, recursively, as full paths."""
        out, found = [], self._fs.listFiles(self.path(p), True)
        while found.hasNext():
            out.append(found.next().getPath().toString())
        return sorted(out)

    def delete(self, p: str) -> None:
        self._fs.delete(self.path(p), True)

    def set_time(self, p: str, millis: int) -> bool:
        """Set a file's modification time; False where the store refuses."""
        try:
            self._fs.setTimes(self.path(p), millis, -1)
        except Exception:  # noqa: BLE001 - object stores refuse in different ways
            return False
        return True

    def time_of(self, p: str) -> int:
        return self._fs.getFileStatus(self.path(p)).getModificationTime()
