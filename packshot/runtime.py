"""Session helpers shared by the operators."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    A temporary folder is used only where the session names none and runs on one machine, as
    tests do; a cluster has to name a folder that every executor can reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="packshot-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def application_folder(spark: SparkSession) -> str:
    """The folder of all that this application stores for itself, below :func:`scratch_folder`."""
    return f"{scratch_folder(spark).rstrip('/')}/packshot-{spark.sparkContext.applicationId}"


def remove_stored(spark: SparkSession) -> bool:
    """Remove what the application has stored for itself, at the end of a job: results that were not written are lost with it.

    Says whether there was anything.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the plan starts from a stored table.

    A stored Parquet table survives the loss of executors, and its readers still prune columns.
    The tables of an application lie in one folder, named by its id, which :func:`remove_stored` removes.
    """
    spark = df.sparkSession
    path = f"{application_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_table(df: DataFrame) -> None:
    """Remove a table of :func:`materialise` that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of queries that are done: Spark removes them when the driver's heap is collected."""
    gc.collect()
    spark._jvm.System.gc()


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``max_rows`` rows, else leave it to Catalyst.

    The check reads no more than ``max_rows + 1`` rows. Meant for configuration tables.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
