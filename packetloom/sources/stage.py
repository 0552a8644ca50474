"""Tables written between steps, in the shared folder the cluster names.

A written table survives lost executors, is read with column pruning, and keeps a step that is used by
several later ones from being computed again for each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def stage_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`, which a cluster sets to a shared folder, or the folder of `setCheckpointDir`.

    Where neither is set, one process that is driver and executor alike takes Spark's warehouse folder. A cluster has to name a
    folder: on a machine's own disk, tables would be read back with the rows of other executors missing.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/packetloom"


_open_scopes: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{stage_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Tables written between steps inside the `with` block are deleted at its end; write the result before that."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Values of a partition column that a task keeps open files for. With more of them it sorts the rest of its rows.
OPEN_FILES = 16


@contextmanager
def open_files(spark: SparkSession, count: int = OPEN_FILES) -> Iterator[None]:
    """Writers with a partition column inside the `with` block keep a file open per value, instead of sorting all rows of a task by it first:
    whole rows with their payloads, which spill once a task reads more than its memory holds."""
    option = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(option)
    spark.conf.set(option, count)
    try:
        yield
    finally:
        spark.conf.set(option, before)


def write_stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` as parquet once and return the table read back. Few values of `partition_by` take no sort."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by is None:
        writer.parquet(path)
    else:
        with open_files(spark):
            writer.partitionBy(partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
