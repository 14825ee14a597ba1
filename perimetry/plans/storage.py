"""Where intermediate tables go, and how they are deleted."""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. A local session that names none uses its
    warehouse folder; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        folder = spark.conf.get("spark.sql.warehouse.dir")
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/perimetry/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage, survives lost executors, and every
    later use reads only the columns it needs. The table stays until ``release``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table made at ``scratch_path`` once its outputs are written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    if path in _MADE:
        _MADE.remove(path)


def made() -> frozenset[str]:
    """Tables of this process that are still there."""
    return frozenset(_MADE)


def release(spark: SparkSession, keep: Collection[str] = ()) -> None:
    """Delete the tables of this process that are still there, but for ``keep``. Call it when the results
    of queries that wrote some have been read or stored: frames are lazy, so the queries cannot know."""
    for path in made().difference(keep):
        discard(spark, path)
