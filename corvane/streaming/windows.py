"""Structured Streaming: windows with watermarks, deduplication with an end, the portfolio's keyed state, and the same
aggregates over a bounded table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream(spark: SparkSession, path: str, files_a_trigger: int = 1) -> DataFrame:
    """Events from Parquet files as they arrive; ``ts`` as a timestamp."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, size: str = "1 day", late: str = "1 day") -> DataFrame:
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")


def sliding(events: DataFrame, size: str = "7 days", step: str = "1 day", late: str = "1 day") -> DataFrame:
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.window("ts", size, step).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def unique(events: DataFrame, keys: list[str], late: str = "90 days") -> DataFrame:
    """The first event of each key; a key is forgotten when the watermark has passed it by ``late``."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def portfolio(seen: DataFrame, emerging: int = 3, confirmed: int = 7, dismiss: int = 14) -> DataFrame:
    """Streaming portfolio: each signal's state holds the days it was seen on; emits its status when that may change.

    ``seen``: ``signal, day`` (date). State is at most ``confirmed`` days and the last one. A signal unseen for ``dismiss`` days of event
    time is told as dismissed once the watermark has passed them, and its state goes.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        days, last = (set(state.get[0].split(",")), state.get[1]) if state.exists else (set(), "")
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"signal": [key[0]], "days": [len(days)], "status": ["dismissed"]})
            return
        for pdf in batches:
            new = {str(d)[:10] for d in pdf["day"]}
            days, last = (days | new if len(days) < confirmed else days), max(last, *new)
        days = set(sorted(days)[:confirmed])
        state.update((",".join(sorted(days)), last))
        state.setTimeoutTimestamp(max(int(pd.Timestamp(last).timestamp() * 1000) + dismiss * 86_400_000, state.getCurrentWatermarkMs() + 1))
        n = len(days)
        yield pd.DataFrame({"signal": [key[0]], "days": [n], "status": ["confirmed" if n >= confirmed else "emerging" if n >= emerging else "watching"]})

    timed = seen.withColumn("at", F.col("day").cast("timestamp")).withWatermark("at", "0 days")
    return timed.groupBy("signal").applyInPandasWithState(step, "signal string, days long, status string", "days string, last string", "update", "EventTimeTimeout")


def breaker(calls: DataFrame, failures: int = 5, wait: int = 300, probes: int = 3) -> DataFrame:
    """Streaming circuit breakers, one a ``site``: ``calls`` (``site, ts, ok``) by event time; emits ``site, state, failed, since`` with each
    batch of its calls. ``failures`` in a row open it; ``wait`` seconds later a call is a probe; ``probes`` good ones in a row close it
    again, a bad one opens it anew. Calls while it is open are refused and change nothing."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        now = tuple(state.get) if state.exists else CLOSED
        rows = pd.concat(list(batches)).sort_values("ts", kind="stable")
        for ts, ok in zip(rows["ts"], rows["ok"], strict=True):
            now = breaker_step(now, ts.timestamp(), bool(ok), failures, wait, probes)
        state.update(now)
        yield pd.DataFrame({"site": [key[0]], "state": [now[0]], "failed": [now[1]], "since": [now[3]]})

    return calls.groupBy("site").applyInPandasWithState(step, "site string, state string, failed long, since double", "state string, failed long, good long, since double", "update", "NoTimeout")


CLOSED = ("closed", 0, 0, 0.0)


def breaker_step(now: tuple, at: float, ok: bool, failures: int = 5, wait: int = 300, probes: int = 3) -> tuple:
    """The state (name, failures in a row, good probes, open since) after a call at a time in seconds."""
    name, failed, good, since = now
    if name == "open":
        if at < since + wait:
            return now
        name, good = "half_open", 0
    if name == "half_open":
        if not ok:
            return ("open", failed + 1, 0, at)
        return CLOSED if good + 1 >= probes else ("half_open", failed, good + 1, since)
    failed = 0 if ok else failed + 1
    return ("open", failed, 0, at) if failed >= failures else ("closed", failed, 0, 0.0)


def breakers(calls: DataFrame, failures: int = 5, wait: int = 300, probes: int = 3) -> DataFrame:
    """``site, state, failed, good, since, opened`` after all ``calls`` (``site, ts, ok``) of a bounded table: the same steps as one fold over a
    site's calls in order, in SQL functions. A site's calls are one row while it is folded."""
    rows = calls.groupBy("site").agg(F.array_sort(F.collect_list(F.struct(F.col("ts").cast("double").alias("at"), F.col("ok").alias("ok")))).alias("calls"))
    make = lambda name, failed, good, since, opened: F.struct(F.lit(name).alias("state"), failed.cast("long").alias("failed"), good.cast("long").alias("good"), since.cast("double").alias("since"), opened.cast("long").alias("opened"))
    zero = F.lit(0)

    def step(s, x):
        shut = make("closed", zero, zero, zero, s["opened"])
        opens = make("open", s["failed"] + 1, zero, x["at"], s["opened"] + 1)
        good = F.when(s["state"] == "half_open", s["good"]).otherwise(zero) + 1
        probe = F.when(~x["ok"], opens).when(good >= probes, shut).otherwise(make("half_open", s["failed"], good, s["since"], s["opened"]))
        normal = F.when(x["ok"], shut).when(s["failed"] + 1 >= failures, opens).otherwise(make("closed", s["failed"] + 1, zero, zero, s["opened"]))
        return F.when((s["state"] == "open") & (x["at"] < s["since"] + wait), s).when(s["state"] == "closed", normal).otherwise(probe)

    return rows.select("site", F.aggregate("calls", make("closed", zero, zero, zero, zero), step).alias("s")).select("site", "s.*")


def append_once(df: DataFrame, path: str, checkpoint: str):
    """Write a stream's batches so that a batch told again after a failure replaces itself: a folder a batch, by its number. With the
    checkpoint, every row of a replayable source is in the table exactly once."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unseen(urls: DataFrame, done: DataFrame, key: str = "url_key") -> DataFrame:
    """Rows of a batch or stream whose key is not in a bounded table of what is done, each key once."""
    return urls.join(done.select(key).distinct(), key, "left_anti").dropDuplicates([key])


def run_once(df: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Run a stream over what there is into a table in memory (for small results and tests)."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)
