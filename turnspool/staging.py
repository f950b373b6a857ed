"""How rows lie between stages: tables that several stages read, and small inputs.

A staged table is Parquet in the shared folder named by ``spark.checkpoint.dir``, so it
outlives executors, cuts lineage, and (unlike a checkpointed RDD) can be read column by column.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="turnspool-")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` or ``setCheckpointDir`` names.

    Where neither is set, a temporary folder will do for a local master; executors on other
    machines would not see it, so there it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        folder = _local_dir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a reader over the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Put the rows of a small input on all cores; ``keys`` tell rows apart.

    A scan hands out whole row groups, so a file with one row group is one task's work while the
    other cores idle. An input with as many scan tasks as cores, as any large one, is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
