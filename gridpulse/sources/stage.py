"""Results that are read more than once, written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder of this process, in local mode only."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="gridpulse-"))
    return _own[0]


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet and read from there: it is not computed again, and a lost executor costs a re-read."""
    path = f"{root(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
