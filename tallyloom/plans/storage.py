"""Intermediate tables on the shared file system, and small-input spreading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, as the cluster names it.

    Without ``spark.checkpoint.dir`` a local session gets a temporary folder; a
    cluster gets an error, because its executors do not share one machine's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tallyloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_and_read(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` as parquet and return it read back.

    The written table survives the loss of any executor, ends the lineage and
    has a known size, from which Spark picks join strategies.
    """
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the work folder once, for plans that read it repeatedly."""
    return write_and_read(df, new_folder(df.sparkSession, name))


def spread(df: DataFrame) -> DataFrame:
    """Give an input with fewer splits than cores one partition per core.

    Large inputs have far more splits than cores and pass through unchanged; a
    small file would otherwise be processed by one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def is_table(spark: SparkSession, folder: str) -> bool:
    """Whether the folder still is a table that can be read."""
    try:
        spark.read.parquet(folder)
    except AnalysisException:
        return False
    return True


def file_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files that a table is read from."""
    files = spark.read.parquet(path).select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return (path, *sorted(tuple(row) for row in files.collect()))
