"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from terrawatt.session import FREE_SHUFFLES, settings


def shared_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; where it is unset (tests), a folder beside the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-scratch").rstrip("/")


class Scratch:
    """Writes tables below the shared folder and reads them back, which cuts the lineage and frees the job's shuffle files.

    A lost executor re-runs only the job that writes the current table. Tables go when `drop` is
    called or, for those a lazy result still reads, when the application ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.deleteOnExit(self._path(self.root))

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        with settings(self.spark, FREE_SHUFFLES):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._fs.delete(self._path(f"{self.root}/{name}"), True)
