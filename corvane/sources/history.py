"""Documents and histories in JSON, and the archive of old days."""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import keep_one

_DAY = r"(\d{4}-\d{2}-\d{2})"


def read_documents(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON documents, one a file, over as many lines as they take, with the day that the path names (``data_date``, '' without one). A file
    that is no JSON is dropped."""
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    return df.withColumn("data_date", F.regexp_extract(F.col("_metadata.file_path"), _DAY, 1))


def append_history(df: DataFrame, path: str) -> None:
    """Add rows to a history of JSON lines. Nothing there is rewritten: each run adds files that appear when it commits."""
    df.withColumn("written_at", F.unix_micros(F.current_timestamp())).write.mode("append").json(path)


def read_history(spark: SparkSession, path: str, schema: T.StructType, day: str = "day") -> DataFrame:
    """A history with one row a day: that of the last run that told it (of several in one run, one by all columns). Broken lines are dropped."""
    told = T.StructType([*schema, T.StructField("written_at", T.LongType())])
    rows = spark.read.schema(told).option("mode", "DROPMALFORMED").json(path).where(F.col(day).isNotNull())
    return keep_one(rows, [day], [F.desc_nulls_last("written_at"), F.to_json(F.struct(*schema.names))]).select(schema.names)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def archive(spark: SparkSession, path: str, to: str, today: datetime.date, days: int = 30, margin: int = 2, by: str = "crawl_date", dry: bool = False) -> DataFrame:
    """Move partitions of more than ``days`` days before ``today`` into the table ``to``: ``day, rows`` of each. The last ``margin`` days stay
    whatever ``days`` says, and so do rows without a day. ``dry`` only tells what would go.

    Days that the archive has already are not written again: with other rows there (some came late) the run raises before it changes anything.
    A day leaves its table after the copy has the same rows by count and hash, by one renaming into a name that no reader sees; only then
    are its files deleted. So a run may end anywhere and be started again: a day is whole in one of the two tables at least.
    """
    last = today - datetime.timedelta(days=max(days, margin))
    old = spark.read.parquet(path).where(F.col(by).cast("date") < F.lit(last))
    columns = sorted(old.columns)

    def sums(df: DataFrame) -> dict:  # a row for each day
        n = df.groupBy(F.col(by).cast("date").alias("day")).agg(F.count("*").alias("rows"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("hash"))
        return {r.day: (r.rows, r.hash) for r in n.collect()}

    going = sums(old)
    told = spark.createDataFrame([(d, going[d][0]) for d in sorted(going)], "day date, rows long")
    if dry or not going:
        return told
    try:
        there = sums(spark.read.parquet(to).where(F.col(by).cast("date").isin(list(going))))
    except AnalysisException:  # no archive yet
        there = {}
    late = sorted(d for d in there if there[d] != going[d])
    if late:
        raise RuntimeError(f"the archive has other rows of {', '.join(map(str, late))}; nothing was changed")
    old.where(~F.col(by).cast("date").isin(list(there))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(by).parquet(to)
    kept = sums(spark.read.parquet(to).where(F.col(by).cast("date").isin(list(going))))
    if kept != going:
        raise RuntimeError("the archive differs from what was to go; nothing was deleted")
    fs, name = _file_system(spark, path)
    for d in sorted(going):  # names of days, not rows
        hidden = name(f"{path}/_archived-{d}")
        fs.delete(hidden, True)
        if not fs.rename(name(f"{path}/{by}={d}"), hidden):
            raise RuntimeError(f"{d} could not be moved")
        fs.delete(hidden, True)
    return told
