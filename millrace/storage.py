"""Small files and folders on whatever file system a path names, through the file systems Spark itself uses."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession

from millrace.session import list_paths


def _at(spark: SparkSession, path: str) -> tuple[Any, Any]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return bool(fs.exists(where))


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None where there is none."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, *, replace: bool = False) -> None:
    """A small file, seen whole or not at all: written beside its place and renamed. An existing one is an error unless
    ``replace`` is given; then it is gone for a moment, so a reader needs a way to do without it."""
    fs, where = _at(spark, path)
    if not replace and fs.exists(where):
        raise FileExistsError(path)
    _, beside = _at(spark, f"{where.getParent().toString()}/.{where.getName()}.new")
    stream = fs.create(beside, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if replace:
        fs.delete(where, False)
    if not fs.rename(beside, where):
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a whole folder; nothing there is no error."""
    fs, where = _at(spark, path)
    fs.delete(where, True)


def modified_ms(spark: SparkSession, path: str) -> int:
    """When a file or folder was changed last, in milliseconds."""
    fs, where = _at(spark, path)
    return int(fs.getFileStatus(where).getModificationTime())


class CommitLog:
    """Numbered JSON commits in a folder, each seen whole or not at all. The newest one counts.

    A pointer tells its number; it may lag by what was committed since, and is gone while it is replaced. Only then is the
    folder listed. The last ``kept`` commits stay."""

    def __init__(self, spark: SparkSession, folder: str, kept: int = 16) -> None:
        self.spark, self.folder, self.kept = spark, folder, kept

    def newest(self) -> tuple[int, Any]:
        """The number and content of the newest commit, -1 and None where there is none."""
        pointer = read_text(self.spark, f"{self.folder}/current")
        if pointer is None:
            names = [path.rsplit("/", 1)[1] for path in list_paths(self.spark, f"{self.folder}/*.json")]
            pointer = max((int(name.removesuffix(".json")) for name in names), default=-1)
        number = int(pointer)
        while exists(self.spark, f"{self.folder}/{number + 1}.json"):  # committed, pointer not yet moved
            number += 1
        return number, json.loads(read_text(self.spark, f"{self.folder}/{number}.json")) if number >= 0 else None

    def commit(self, number: int, content: Any) -> None:
        """Write commit ``number``; an error if it is there already."""
        write_text(self.spark, f"{self.folder}/{number}.json", json.dumps(content))
        write_text(self.spark, f"{self.folder}/current", str(number), replace=True)
        remove(self.spark, f"{self.folder}/{number - self.kept}.json")
