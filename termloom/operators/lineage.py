"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: spark.checkpoint.dir of the session, or a temporary one where it is unset on a local master."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = getattr(shared_dir, "local", None) or tempfile.mkdtemp(prefix="termloom-")
        shared_dir.local = path
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; Hadoop deletes it when the driver's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more; other tables are left alone."""
    path = getattr(df, "_staged_at", None)
    if path:
        spark = df.sparkSession
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def computed(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """rows with a column that later filters find computed: pushed below, they would carry its expression with them."""
    x = rows.withColumn("__v", value)
    return x.select(*rows.columns, F.explode(F.array("__v")).alias(name))
