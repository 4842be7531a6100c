"""The cluster's shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpointed(df: DataFrame) -> DataFrame:
    """df as a table in the folder of spark.checkpoint.dir, which all executors share: cuts the lineage and, other than checkpoint(), the
    estimate of its size, which would grow without bound in loops. Where that setting is unset, a temporary folder if all runs on this
    machine, else an error."""
    spark = df.sparkSession
    path = shared_path(spark, "step")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def emptied(df: DataFrame) -> None:
    """Give back the space of a table that `checkpointed` has made and nothing reads any more."""
    df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(df.shared_path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, also when it runs from a source folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    return spark
