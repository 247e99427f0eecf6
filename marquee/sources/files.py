"""Small files and folders of the shared store, through Hadoop's file system:
whatever scheme the path has, the driver's calls reach the same store as the
executors' reads and writes. Nothing here touches data."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    fs, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def state(spark: SparkSession, path: str) -> list[int]:
    """What changes if files below a path are added, replaced or deleted: their
    number, their bytes, and when the path itself was last changed."""
    fs, where = _at(spark, path)
    below = fs.getContentSummary(where)
    return [below.getFileCount(), below.getLength(), fs.getFileStatus(where).getModificationTime()]


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


class Opened:
    """A file opened for reads of stated ranges of bytes."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        fs, where = _at(spark, path)
        self.size = fs.getFileStatus(where).getLen()
        self._stream, self._bytes = fs.open(where), spark._jvm.org.apache.commons.io.IOUtils.toByteArray

    def read(self, at: int, n: int) -> bytes:
        if not n:
            return b""
        self._stream.seek(at)
        return bytes(self._bytes(self._stream, n))

    def __enter__(self) -> Opened:
        return self

    def __exit__(self, *_) -> None:
        self._stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there whole or not at all: written under a hidden name,
    then renamed. Fails if ``path`` exists."""
    folder, _, name = path.rpartition("/")
    fs, where = _at(spark, path)
    _, hidden = _at(spark, f"{folder}/.{name}.part")
    out = fs.create(hidden, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(where) or not fs.rename(hidden, where):
        raise FileExistsError(f"{path} is there already")


def delete(spark: SparkSession, path: str) -> None:
    """A file or a whole folder; nothing happens if it isn't there."""
    fs, where = _at(spark, path)
    fs.delete(where, True)
