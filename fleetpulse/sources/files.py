"""Folders and small files of a shared store, through Hadoop's file systems, so that any store Spark reads will do."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


class Store:
    """A few operations of the file system that holds a path."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._jvm = spark.sparkContext._jvm
        # Every name on the way to a class is a call.
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._path(path)
        return place.getFileSystem(self._conf), place

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if it does not exist."""
        files, place = self._at(folder)
        return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []

    def matches(self, pattern: str) -> bool:
        """Whether a file or a folder matches a pattern."""
        files, place = self._at(pattern)
        return len(files.globStatus(place)) > 0

    def paths(self, pattern: str) -> list[str]:
        """Files in the folders that match a pattern, listed by Spark in one job however many they are."""
        return [r["path"] for r in self._spark.read.format("binaryFile").load(pattern).select("path").collect()]

    def delete(self, path: str) -> None:
        files, place = self._at(path)
        files.delete(place, True)

    def rename(self, path: str, new: str) -> None:
        files, place = self._at(path)
        files.rename(place, self._at(new)[1])

    def set_times(self, times: dict[str, int]) -> None:
        """Sets when files of one store were last changed, several at once."""
        if not times:
            return
        files, _ = self._at(next(iter(times)))
        with ThreadPoolExecutor(8) as threads:
            list(threads.map(lambda at: files.setTimes(self._path(at), times[at] * 1000, -1), times))

    def read_text(self, path: str) -> str:
        files, place = self._at(path)
        stream = files.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Writes a small file under another name and renames it, so that it is there as a whole or not at all."""
        files, place = self._at(path)
        _, draft = self._at(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        stream = files.create(draft)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        if files.exists(place):
            files.delete(place, False)
        files.rename(draft, place)
