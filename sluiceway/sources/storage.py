"""Directory handling through Hadoop's file system API, and shared scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_issued: list[str] = []

# Hadoop settings of the flow at hand, and the file systems opened with them.
_settings: ContextVar[tuple[tuple[str, str], ...]] = ContextVar("settings", default=())
_opened: dict[tuple, Any] = {}


@contextmanager
def hadoop_settings(options: Mapping[str, str] | None) -> Iterator[None]:
    """Within the block, directories are reached with these options besides the session's: those that begin with `fs.`."""
    token = _settings.set(tuple(sorted((k, str(v)) for k, v in (options or {}).items() if k.startswith("fs."))))
    try:
        yield
    finally:
        _settings.reset(token)


def apart(path: str, options: Mapping[str, str] | None) -> dict[str, str]:
    """The options of a store. With some for file systems, Spark opens those of the path's scheme apart as well: Hadoop would keep what these
    settings opened for all others that use the same scheme and authority."""
    scheme = path.partition("://")[0] if "://" in path else ""
    alone = {f"fs.{scheme}.impl.disable.cache": "true"} if scheme and any(k.startswith("fs.") for k in options or {}) else {}
    return {**alone, **(options or {})}


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    settings, session = _settings.get(), spark._jsc.hadoopConfiguration()
    if not settings:
        return _path(spark, path).getFileSystem(session)
    # Hadoop keeps one file system per scheme and authority, whatever the settings: these are opened apart.
    uri = _path(spark, path).toUri()
    known = (id(spark.sparkContext), uri.getScheme(), uri.getAuthority(), settings)
    if known not in _opened:
        merged = spark._jvm.org.apache.hadoop.conf.Configuration(session)
        for name, value in settings:
            merged.set(name, value)
        base = uri if uri.getScheme() else spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(merged)
        _opened[known] = spark._jvm.org.apache.hadoop.fs.FileSystem.newInstance(base, merged)
    return _opened[known]


def qualified(spark: SparkSession, path: str) -> str:
    """Full URI of a path, without a trailing slash."""
    return _fs(spark, path).makeQualified(_path(spark, path)).toString().rstrip("/")


def decoded(spark: SparkSession, uri: str) -> str:
    """Path for a URL-encoded URI, as found in Spark's file metadata column."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def is_directory(spark: SparkSession, path: str) -> bool:
    return exists(spark, path) and _fs(spark, path).getFileStatus(_path(spark, path)).isDirectory()


def modified(spark: SparkSession, path: str) -> float:
    """When a file was last written, in seconds since 1970."""
    return _fs(spark, path).getFileStatus(_path(spark, path)).getModificationTime() / 1000


def children(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    """Names of the entries of a directory that match a glob pattern; none if it does not exist.

    The match is made by the file system, so a directory of many data files costs one listing.
    """
    found = _fs(spark, path).globStatus(_path(spark, f"{path}/{pattern}"))
    return sorted(status.getPath().getName() for status in found or ())


def matches(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Paths below a directory that match a glob pattern of several levels."""
    found = _fs(spark, path).globStatus(_path(spark, f"{path}/{pattern}"))
    base = len(qualified(spark, path)) + 1
    return sorted(status.getPath().toString()[base:] for status in found or ())


def files(spark: SparkSession, path: str) -> list[str]:
    """Paths below a directory of all files in it, without markers and checksums."""
    if not exists(spark, path):
        return []
    found, listing = [], _fs(spark, path).listFiles(_path(spark, path), True)
    base = len(qualified(spark, path)) + 1
    while listing.hasNext():
        name = listing.next().getPath().toString()[base:]
        if not any(part.startswith(("_", ".")) and "=" not in part for part in name.split("/")):
            found.append(name)
    return sorted(found)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files of a directory."""
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def rename(spark: SparkSession, source: str, target: str) -> None:
    if not _fs(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"cannot rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).delete(_path(spark, path), True)


def make_directory(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file, such as a pinned schema."""
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all. One that exists already is an error."""
    if exists(spark, path):
        raise RuntimeError(f"another writer has made {path}")
    draft = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    rename(spark, draft, path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    stream = _fs(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; a temporary one in local mode only."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="sluiceway-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root; nothing is created yet."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _issued.append(path)
    return path


def staged(df: DataFrame, path: str) -> DataFrame:
    """`df` written to a scratch path and read from there: a cut in its lineage that outlives executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Delete one scratch path."""
    delete(spark, path)
    if path in _issued:
        _issued.remove(path)


def release_all(spark: SparkSession) -> None:
    """Delete all scratch paths of this process; DataFrames read from them end here."""
    for path in list(_issued):
        release(spark, path)
