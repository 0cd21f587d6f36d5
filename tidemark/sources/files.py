"""Small metadata files on whatever file system Spark is configured for."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class MetadataFolder:
    """Numbered JSON documents; the highest number is current.

    A document appears by one rename, so a reader sees all of it or none. One writer at a time
    is assumed: a number that already exists is refused.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._path = path.rstrip("/")
        self._root = self._jvm.org.apache.hadoop.fs.Path(self._path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{name}")

    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._root):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(self._root)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def latest_number(self) -> int | None:
        return max(self._numbers(), default=None)

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._file(f"{number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> dict | None:
        number = self.latest_number()
        return None if number is None else self.read(number)

    def latest_before(self, number: int) -> dict | None:
        """The newest document below ``number``: what a batch found, even if it is replayed."""
        known = [n for n in self._numbers() if n < number]
        return self.read(known[-1]) if known else None

    def put(self, number: int, document: dict) -> None:
        """Write a document unless it is there already."""
        if not self._fs.exists(self._file(f"{number:012d}.json")):
            self.write(number, document)

    def write(self, number: int, document: dict) -> None:
        final = self._file(f"{number:012d}.json")
        draft = self._file(f".draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(document).encode("utf-8")))
        finally:
            stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise RuntimeError(f"version {number} of {self._path} was written by another job")

    def expire(self, keep: int) -> None:
        """Delete all but the newest ``keep`` documents."""
        for number in self._numbers()[:-keep]:
            self._fs.delete(self._file(f"{number:012d}.json"), False)


def _located(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; empty if it does not exist."""
    root, fs = _located(spark, path)
    if not fs.exists(root):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(root) if status.isDirectory())


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job has written all of ``path``."""
    mark, fs = _located(spark, f"{path}/_SUCCESS")
    return fs.exists(mark)


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Those of :func:`child_folders` that a job has written to the end."""
    return [name for name in child_folders(spark, path) if is_finished(spark, f"{path}/{name}")]


def delete_folder(spark: SparkSession, path: str) -> None:
    root, fs = _located(spark, path)
    fs.delete(root, True)
