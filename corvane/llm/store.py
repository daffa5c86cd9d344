"""Tables that outlive an executor: written to the folder all nodes share, then read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset and the master local (tests), a folder picked once."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all nodes share")
        found = tempfile.mkdtemp(prefix="corvane-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return it reread: cuts the lineage, survives lost executors.

    The table's path is new on every call. Columns and types stay as they are; row order does not count.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/corvane-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
