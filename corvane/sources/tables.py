"""Scans, sinks and checks of tables: dated partitions, keep-first and keep-last, declared schemas, catalogues."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW = T.StructType([T.StructField(n, T.StringType()) for n in ("url", "source_domain", "title", "body", "source_id", "source_name", "language", "published_at", "crawled_at", "author", "category", "content_hash")] + [T.StructField("crawl_tier", T.IntegerType()), T.StructField("crawl_method", T.StringType()), T.StructField("is_paywall_truncated", T.BooleanType()), T.StructField("evidence_id", T.StringType())])


def folder(spark: SparkSession) -> str:
    """The folder that all nodes share: the session's ``spark.checkpoint.dir``; one of its own only with a local master that has none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all nodes share")
        found = tempfile.mkdtemp(prefix="corvane-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Write a table into the folder that all nodes share and read it again: cuts the lineage for iterations."""
    path = f"{folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete a table that ``settle`` returned and that nothing reads any more; other tables are refused."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if not path.rpartition("/")[2].startswith("table-"):
            raise ValueError(f"{path} is no settled table")
        path = spark._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW, dated: bool = False) -> DataFrame:
    """JSON lines; blank and broken lines are dropped. ``dated`` adds ``data_date`` from the path."""
    df = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return df.withColumn("data_date", F.regexp_extract(F.input_file_name(), r"(\d{4}-\d{2}-\d{2})", 1)) if dated else df


def read_window(spark: SparkSession, path: str, end: str, days: int, columns: list[str] | None = None) -> DataFrame:
    """The last ``days`` days of a table partitioned by ``crawl_date``; partitions outside are not read."""
    df = spark.read.option("mergeSchema", "true").parquet(path).where(F.col("crawl_date").between(F.date_sub(F.lit(end).cast("date"), days - 1), F.lit(end).cast("date")))
    return df.select(*columns, "crawl_date") if columns else df


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The last day of a partitioned table."""
    df = spark.read.parquet(path)
    return df.join(F.broadcast(df.agg(F.max("crawl_date").alias("crawl_date"))), "crawl_date", "left_semi")  # one row


def write_table(df: DataFrame, path: str, schema: T.StructType, by: list[str] | None = None) -> None:
    """Check, coerce and write as zstd Parquet; the committer makes the result appear at once."""
    problems = check_schema(df, schema)
    if problems:
        raise ValueError("; ".join(problems))
    w = coerce(df, schema, by or []).write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(*by) if by else w).parquet(path)


def _alike(a: T.DataType, b: T.DataType) -> bool:
    """Any integer is like any other, so are floats, timestamps and lists of like elements."""
    ints, floats, times = (T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType), (T.TimestampType, T.TimestampNTZType)
    for kinds in (ints, floats, times):
        if isinstance(a, kinds) and isinstance(b, kinds):
            return True
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return _alike(a.elementType, b.elementType)
    return type(a) is type(b)


def check_schema(df: DataFrame, schema: T.StructType) -> list[str]:
    """What is wrong: missing columns, types that aren't alike, nulls where none may be (one pass)."""
    have = {f.name: f.dataType for f in df.schema}
    out = [f"{f.name} is missing" for f in schema if f.name not in have]
    out += [f"{f.name} is {have[f.name].simpleString()}" for f in schema if f.name in have and not _alike(have[f.name], f.dataType)]
    must = [f.name for f in schema if not f.nullable and f.name in have]
    if must:
        nulls = df.agg(*(F.sum(F.col(c).isNull().cast("int")).alias(c) for c in must)).first()
        out += [f"{c} has {nulls[c]} nulls" for c in must if nulls[c]]
    return out


def coerce(df: DataFrame, schema: T.StructType, more: list[str] | None = None) -> DataFrame:
    """The declared columns with their types; others are dropped but for ``more``."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema), *(more or []))


def keep_one(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; ties are for the caller to break."""
    return df.withColumn("_at", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_at = 1").drop("_at")


def numbered(df: DataFrame, by: str, order: list[str], name: str = "k") -> DataFrame:
    """``df`` with the place of each row (from 1) in ``order`` within ``by``: ranges are sorted apart and the counts of the ranges before are
    added, so that no group is one task. ``by`` and ``order`` are not null."""
    rows = settle(df.repartitionByRange(by, *order).sortWithinPartitions(by, *order).withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", 33))
    each = Window.partitionBy(by).orderBy("_part")
    n = rows.groupBy("_part", by).agg(F.min("_at").alias("_first"), F.count("*").alias("_c"))  # a row for each range and group in it
    shift = settle(n.select("_part", by, (F.sum("_c").over(each) - F.col("_c") - F.col("_first") + 1).alias("_shift")))
    return rows.join(shift, ["_part", by]).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))


def upsert(df: DataFrame, path: str, key: list[str], by: str) -> None:
    """Put rows into a Parquet table that is partitioned by ``by``: rows of equal ``key`` (and ``by``) are replaced, others stay.

    Only partitions that ``df`` touches are read and written, each replaced as a whole when the job commits: a run that fails before leaves
    the table as it was, and the same run again changes no row. Rows of ``df`` that share a key are one of them, by all their columns.
    """
    spark = df.sparkSession
    keys = [by, *key]
    new = settle(keep_one(df.where(F.col(by).isNotNull()), keys, [F.to_json(F.struct(*df.columns))]))
    try:
        old = spark.read.schema(df.schema).parquet(path)
    except AnalysisException:  # no table yet
        old = None
    if old is not None:
        here = old.join(new.select(by).distinct(), by, "left_semi").join(new.select(*keys), keys, "left_anti").select(df.columns)
        new = settle(new.unionByName(here))
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def left_join_first(base: DataFrame, more: DataFrame, key: str, columns: list[str], order: list[Column]) -> DataFrame:
    """Left join with the first row of each key on the right; a null key meets nothing."""
    return base.join(keep_one(more.where(F.col(key).isNotNull()), [key], order).select(key, *columns), key, "left")


def densify(df: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Every key on every day between the first and last one of the table, 0 where there is nothing."""
    days = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(F.explode(F.expr("sequence(lo, hi)")).alias(day))
    return df.select(key).distinct().crossJoin(F.broadcast(days)).join(df.groupBy(key, day).agg(F.sum(value).alias(value)), [key, day], "left").withColumn(value, F.coalesce(value, F.lit(0)))  # days are bounded by the calendar


def quality(df: DataFrame, key: str, parent: DataFrame | None = None, parent_key: str | None = None) -> DataFrame:
    """One row: rows, null and repeated keys, keys that ``parent`` lacks, and the share of nulls in every column."""
    n = df.agg(F.count("*").alias("n"), F.sum(F.col(key).isNull().cast("int")).alias("null_keys"), (F.count(key) - F.countDistinct(key)).alias("repeated_keys"), *(F.avg(F.col(c).isNull().cast("double")).alias(f"null_{c}") for c in df.columns if c != key))
    if parent is None:
        return n
    return n.crossJoin(df.select(key, parent_key).join(parent.select(parent_key), parent_key, "left_anti").agg(F.count("*").alias("orphans")))  # one row each


def checksum(df: DataFrame) -> DataFrame:
    """One row: rows and an order-independent hash of the contents."""
    return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("hash"))


def digest(df: DataFrame, columns: list[str] | None = None, null: str = "-") -> DataFrame:
    """One row: rows and an order-independent digest that any engine can tell: the sum, as text, of the first 12 hexadecimal digits of the
    SHA-256 of each row's values, as text between bars, ``null`` for nulls."""
    row = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit(null)) for c in columns or df.columns))
    first = F.conv(F.substring(F.sha2(row, 256), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(first), F.lit(0).cast("decimal(38,0)")).cast("string").alias("digest"))
