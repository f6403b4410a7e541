"""Small files and folders on whatever file system Spark knows; rows never pass through here."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession

#: Characters that a writer holds before it hands them to the file system.
_BUFFER = 1 << 20


def filesystem(spark: SparkSession, path: str):
    """(the path's file system, the path) as Hadoop objects."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = filesystem(spark, old)
    if not fs.rename(p, filesystem(spark, new)[1]):
        raise OSError(f"can't move {old} to {new}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    fs.mkdirs(p)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, without hidden ones, sorted; none if there is no folder."""
    fs, p = filesystem(spark, folder)
    if not fs.exists(p):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]
    return sorted(n for n in found if not n.startswith((".", "_")))


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if there is no folder."""
    fs, p = filesystem(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def files_below(spark: SparkSession, folder: str) -> Iterator[str]:
    """Paths of all files below a folder. A missing folder raises."""
    fs, root = filesystem(spark, folder)
    if not fs.exists(root):
        raise FileNotFoundError(folder)
    found = fs.listFiles(root, True)
    while found.hasNext():
        yield found.next().getPath().toString()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = filesystem(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A new file; one that exists raises, so that of two writers one fails."""
    fs, p = filesystem(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    stream = fs.create(p, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()


def local_path(path: str) -> str | None:
    """The path on this machine's own disk, or None if it names another file system."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return None if "://" in path else path


class TextFile:
    """A text file written piece by piece beside its place and moved there when it is whole.

    ``keep`` is called before that, to put an earlier file aside.
    """

    def __init__(self, spark: SparkSession | None, path: str, keep: Callable[[], object] | None = None):
        self.spark, self.path, self.local, self.keep = spark, path, local_path(path), keep
        self.parts, self.held = [], 0
        self.staged = f"{self.local or path}.new"
        if self.local:
            os.makedirs(os.path.dirname(os.path.abspath(self.local)), exist_ok=True)
            self.out = open(self.staged, "wb")
        else:
            fs, p = filesystem(spark, self.staged)
            self.out = fs.create(p, True)

    def write(self, text: str) -> int:
        self.parts.append(text)
        self.held += len(text)
        if self.held >= _BUFFER:
            self._flush()
        return len(text)

    def _flush(self) -> None:
        data = "".join(self.parts).encode("utf-8", "replace")
        self.out.write(data if self.local else bytearray(data))
        self.parts, self.held = [], 0

    def __enter__(self) -> TextFile:
        return self

    def __exit__(self, failed, *_) -> None:
        if not failed:
            self._flush()
        self.out.close()
        if not failed and self.keep:
            self.keep()
        if failed:
            os.remove(self.staged) if self.local else delete(self.spark, self.staged)
        elif self.local:
            os.replace(self.staged, self.local)
        else:
            delete(self.spark, self.path)
            rename(self.spark, self.staged, self.path)
