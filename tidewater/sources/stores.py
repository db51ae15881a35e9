"""Opening files of shared storage outside Spark's readers."""

from __future__ import annotations

from pyarrow import fs

ARROW_STORES = ("file", "hdfs", "s3", "gs", "abfs", "abfss")


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
