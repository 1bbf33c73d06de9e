"""Files by path or URI, opened inside tasks: local and shared folders, and the stores that pyarrow knows (s3, gs, hdfs)."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path inside it."""
    if "://" in path and not path.startswith("file:"):
        try:
            return fs.FileSystem.from_uri(path)
        except (ValueError, OSError) as e:
            raise ValueError(f"{path}: no task can open this store; read whole folders through Spark instead ({e})") from e
    return fs.LocalFileSystem(), re.sub("^file:/*", "/", path)


def read_bytes(path: str, offset: int = 0, size: int | None = None) -> bytes:
    """`size` bytes from offset on, or all; fewer than asked for is an error."""
    if offset < 0:
        raise ValueError(f"{path}: an offset is at least 0, not {offset}")
    store, inner = filesystem(path)
    with store.open_input_file(inner) as f:
        got = f.read_at(f.size() - offset if size is None else size, offset) if offset <= f.size() else b""
    if size is not None and len(got) < size:
        raise ValueError(f"{path}: {size} bytes at {offset} are asked for, {len(got)} are there")
    return got


def write_bytes(path: str, raw: bytes) -> None:
    """A file that appears under its name only when it is whole."""
    store, inner = filesystem(path)
    store.create_dir(inner.rpartition("/")[0], recursive=True)
    part = f"{inner}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        f.write(raw)
    store.move(part, inner)


def move(path: str, to: str) -> None:
    store, inner = filesystem(path)
    store.move(inner, filesystem(to)[1])


def delete(path: str) -> None:
    """A file, or a folder with all that is in it; nothing where there is neither."""
    store, inner = filesystem(path)
    kind = store.get_file_info(inner).type
    if kind == fs.FileType.Directory:
        store.delete_dir(inner)
    elif kind == fs.FileType.File:
        store.delete_file(inner)


def listed(folder: str, suffix: str = "") -> list[str]:
    """Files below a folder in order; of a URI, as URIs."""
    store, inner = filesystem(folder)
    head = folder[: -len(inner.lstrip("/"))] if "://" in folder and folder.endswith(inner.lstrip("/")) else ""
    return sorted(head + (x.path.lstrip("/") if head else x.path) for x in store.get_file_info(fs.FileSelector(inner, recursive=True)) if x.is_file and x.path.endswith(suffix))


# Folders by Spark's own stores, on the driver ---------------------------------------------------------------------


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none where it does not exist."""
    files, at = _hadoop(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(at) if x.isDirectory()) if files.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _hadoop(spark, path)
    return bool(files.exists(at))


def remove(spark: SparkSession, path: str) -> None:
    files, at = _hadoop(spark, path)
    files.delete(at, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    files, at = _hadoop(spark, path)
    out = files.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
