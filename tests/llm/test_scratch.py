"""Tables in the shared folder."""

import time

from pyspark.sql import functions as F

from terrawatt.llm.scratch import Scratch


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_their_job(spark):
    before = shuffle_files(spark)
    kept = Scratch(spark, "test").keep(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count(), "rows")
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and kept.count() == 700
