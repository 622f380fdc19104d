"""Session settings for tests, the benchmark and single-machine use; a cluster brings its own session."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; local mode alone can do without."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    root = re.sub(r"^(file:)?/+", "file:///", (found or "/tmp/checkpoints/strataframe").rstrip("/"))
    path = f"{root}/{tag}-{uuid.uuid4().hex}"
    atexit.register(_clean, spark, path)
    return path


def materialized(df: DataFrame, tag: str) -> DataFrame:
    """df as a table in a folder of its own, so that it is worked out once, however often it is read and whoever is lost."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _clean(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session has ended before
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "6g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("strataframe")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", "file:///tmp/checkpoints/strataframe")
        .config("spark.sql.warehouse.dir", "/tmp/checkpoints/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
