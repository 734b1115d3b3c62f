"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
    return f"{at.rstrip('/')}/matchledger-build/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again, so that what follows does not compute it anew."""
    spark, path = df.sparkSession, folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """cut() for tables that only what happens within a `with` block reads: they go at its end."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        path = folder(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        for path in self.paths:
            delete(self.spark, path)
