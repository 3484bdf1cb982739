"""Small files and folders of any file system Spark reaches, through its own Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """File operations on paths of any scheme."""

    def __init__(self, spark: SparkSession):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._hadoop.Path(path)
        return place.getFileSystem(self._conf), place

    def scheme(self, path: str) -> str:
        """The scheme a path resolves to, the default file system's for a bare path."""
        system, place = self._at(path)
        return system.makeQualified(place).toUri().getScheme()

    def local_name(self, path: str) -> str:
        """The path without scheme and authority."""
        system, place = self._at(path)
        return system.makeQualified(place).toUri().getPath()

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        system, place = self._at(path)
        return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []

    def drop(self, path: str) -> bool:
        """Delete a file or a whole folder; false if there was none."""
        system, place = self._at(path)
        return system.delete(place, True)

    def write_new(self, path: str, text: str) -> None:
        """Create a file with its whole text, or fail if there is one of that name.

        The text goes to a hidden file first; a reader sees all of it or nothing.
        """
        system, place = self._at(path)
        hidden = self._hadoop.Path(place.getParent(), f".{place.getName()}")
        stream = system.create(hidden, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if system.exists(place) or not system.rename(hidden, place):
            system.delete(hidden, True)
            raise FileExistsError(path)

    def read(self, path: str) -> str:
        system, place = self._at(path)
        stream = system.open(place)
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()
