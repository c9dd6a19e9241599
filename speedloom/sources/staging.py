"""Staged tables: results written once to shared storage and read back.

Staging cuts lineage in a way that survives lost executors: the table lives in the
folder the cluster names in ``spark.checkpoint.dir``, never in a machine's temporary folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where it is unset, as in tests, a folder in a local session's warehouse.

    On a cluster the warehouse may lie on one machine's disk, so the setting is required there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir") + "/_staged"
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, grouped by application so that it is easy to expire."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/speedloom/{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet to shared storage and return a scan of it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
