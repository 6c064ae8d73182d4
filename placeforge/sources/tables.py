"""Where the engine keeps tables of its own between steps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only where none is set and all runs in one process."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="placeforge-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        place = "file://" + own
        spark.sparkContext.setCheckpointDir(place)
    return place.rstrip("/")


def own_folder(spark: SparkSession) -> str:
    """Where this application's tables are."""
    return f"{work_folder(spark)}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Remove the tables that this application has stored between its steps, once their results are written."""
    remove(spark, own_folder(spark))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The file system that holds a path, and the path as it knows it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """One step on a file system that renames atomically, such as HDFS; an error if it cannot."""
    fs, p = file_system(spark, old)
    if not fs.rename(p, file_system(spark, new)[1]):
        raise OSError(f"{old} cannot become {new}")


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another, which stays where it was if that fails."""
    old = f"{path}.old-{uuid.uuid4().hex}"
    there = exists(spark, path)
    if there:
        rename(spark, path, old)
    try:
        rename(spark, new, path)
    except Exception:
        if there:
            rename(spark, old, path)
        raise
    if there:
        remove(spark, old)
    spark.catalog.refreshByPath(path)
