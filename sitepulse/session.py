"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

# Settings this library relies on. Shuffle width and memory belong to the cluster.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("sitepulse")
    settings = {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # One JVM is driver and executors at once; its default heap of 1 GB is too small for both.
        "spark.driver.memory": "6g",
        # Hundreds of columns are built per report run; their source lines are not needed.
        "spark.sql.dataFrameQueryContext.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else one below the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    if not warehouse:
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/sitepulse/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage with files that outlive a lost executor, and lets later steps prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def observed(seen: Observation) -> dict[str, int]:
    """What an observation counted; nothing where Spark found the plan empty and left it out."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        return {}


def drop(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that no later step reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
