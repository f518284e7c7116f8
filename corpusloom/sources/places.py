"""Folders that all executors share, for intermediate files of the engine."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_MADE: list[tuple[SparkSession, str]] = []


def shared(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder where it is unset and all runs on this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one, deleted when the driver ends."""
    path = f"{shared(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append((spark, path))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for what several tables are made from: it isn't computed for each of
    them, and a lost executor costs nothing above it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _free() -> None:
    for spark, path in _MADE:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001  the session is gone: its folder is the cluster's to clean
            pass
    _MADE.clear()
