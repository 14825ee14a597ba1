"""Runs of a job that are published as a whole.

Each run writes to a folder of its own, ``run-<time>-<number>``, below the output folder. The file ``CURRENT`` there
names the run that readers use; it is replaced in one step and last. So readers see all outputs of one run, or
all of the one before: never a mixture, and nothing of a run that failed.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession

_POINTER = "CURRENT"


def _hadoop(spark: SparkSession, path: str):
    """(file system, full path) of a path, by the session's file systems."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, system.makeQualified(found)


def new_run(out_dir: str) -> str:
    """A folder that no other run writes to."""
    return f"{out_dir.rstrip('/')}/run-{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, run: str) -> None:
    """Make ``run``, whose outputs are complete, the current one of its output folder."""
    out_dir, name = run.rsplit("/", 1)
    system, pointer = _hadoop(spark, f"{out_dir}/{_POINTER}")
    _, waiting = _hadoop(spark, f"{out_dir}/_{_POINTER}.{uuid.uuid4().hex}")
    stream = system.create(waiting, True)
    stream.writeBytes(name)
    stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    files = spark._jvm.org.apache.hadoop.fs.FileContext
    files.getFileContext(system.getUri(), system.getConf()).rename(waiting, pointer, how)


def current_run(spark: SparkSession, out_dir: str) -> str | None:
    """The published run of an output folder; None before the first."""
    system, pointer = _hadoop(spark, f"{out_dir.rstrip('/')}/{_POINTER}")
    if not system.exists(pointer):
        return None
    return f"{out_dir.rstrip('/')}/{spark.read.text(pointer.toString()).first().value}"


def remove_run(spark: SparkSession, run: str) -> None:
    system, folder = _hadoop(spark, run)
    system.delete(folder, True)


def prune(spark: SparkSession, out_dir: str) -> list[str]:
    """Delete all runs but the published one and give their names. Only for times when no run is being written and
    no reader holds an older one."""
    kept = current_run(spark, out_dir)
    system, folder = _hadoop(spark, out_dir)
    names = [s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory()]
    old = sorted(n for n in names if n.startswith("run-") and kept and not kept.endswith(f"/{n}"))
    for name in old:
        remove_run(spark, f"{out_dir.rstrip('/')}/{name}")
    return old
