"""Session settings and the shared scratch location."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app: str = "terrawatt", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; `conf` keys use `__` where Spark uses a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables, on the storage the cluster shares.

    The folder comes from `spark.checkpoint.dir`; where that is unset, as in tests, it lies beside
    the warehouse, which executors share too. What is written there goes when the application ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-scratch"
    path = f"{base.rstrip('/')}/terrawatt/{label}-{uuid.uuid4().hex}"
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(location)
    return path


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold for the jobs started inside and are put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Shuffle files of a job go when it ends; otherwise they stay until the driver happens to collect garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


class Stored:
    """Tables of one operator in a scratch folder; each write cuts the lineage and frees its shuffle files."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, scratch_path(spark, label)

    def write(self, df: DataFrame, name: str, by: tuple[str, ...] = (), **conf: str) -> DataFrame:
        """Appends to the table `name` and returns it; `conf` keys use `__` where Spark uses a dot."""
        with settings(self.spark, {**FREE_SHUFFLES, **{k.replace("__", "."): v for k, v in conf.items()}}):
            df.write.mode("append").option("compression", "zstd").partitionBy(*by).parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            location = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            location.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(location, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make `DataFrame.checkpoint` usable without replacing a folder already configured."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))
