"""Files on any file system Arrow knows (local, HDFS, S3, GCS), on the driver and in tasks."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TypeVar

from pyarrow import fs
from pyspark.sql import SparkSession

_Item = TypeVar("_Item")
_TASK_BYTES = 128 << 20


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path on it) for a plain path or a URI."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if path.startswith(("s3a://", "s3n://")):  # Hadoop's names of Arrow's s3
        path = "s3" + path[3:]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def children(system: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """Direct entries of a folder by name; none if there is no such folder."""
    found = system.get_file_info(fs.FileSelector(folder, recursive=False, allow_not_found=True))
    return sorted(found, key=lambda info: info.base_name)


def wanted_tasks(spark: SparkSession) -> int:
    """How many tasks a scan gets before small pieces share one."""
    return max(16, 4 * spark.sparkContext.defaultParallelism)


def packed(items: Sequence[_Item], sizes: Sequence[int], tasks: int) -> list[list[_Item]]:
    """Neighbours together, as even in bytes as their order allows, in at most ``tasks`` groups, or one per
    ``_TASK_BYTES`` if that is more; each alone if they are no more than that."""
    weights = [s + 1 for s in sizes]
    groups = max(tasks, -(-sum(weights) // _TASK_BYTES))
    if len(items) <= groups:
        return [[item] for item in items]
    found: dict[int, list[_Item]] = {}
    total, before = sum(weights), 0
    for item, weight in zip(items, weights):
        found.setdefault((2 * before + weight) * groups // (2 * total), []).append(item)
        before += weight
    return list(found.values())
