"""Event-time results of a stream of events: days and sessions that are closed for good.

Every event counts once: a second one of the same id within `delay` is dropped. The watermark
trails the latest event time met by `delay`; an event behind it is late, takes no part and is
counted. A window or session is published once, when the watermark has passed its end, so that what
was written never changes. State is what the watermark has not passed: ids and open windows of
about `delay`, whatever the length of the stream.

All results are appended to Parquet by the file sink, which records each batch in its log: a query
that is started again with the same checkpoint goes on where it stopped and writes nothing twice.
Events without time are late; events without id are duplicates of each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerlark import schemas

DELAY, GAP = "1 day", "2 hours"


def read_events(
    spark: SparkSession, path: str, schema: StructType = schemas.EVENTS, files_per_batch: int | None = None
) -> DataFrame:
    """The file `path`, or the files under it, as a stream, oldest first."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # The same path as a pattern: a plain one must be a folder, a pattern may name one file too.
    plain = path.rstrip("/")
    return reader.parquet(f"{plain[:-1]}[{plain[-1]}]")


def unique_events(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Each event once, behind a watermark on `ts`. State for an id ends when the watermark passes it."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def _amount(value: Column) -> Column:
    """Exact, so that sums depend neither on the order of rows nor on how they are cut into batches."""
    return value.cast("decimal(18,4)")


def daily_events(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """day, event_type, events and total of closed days."""
    once = unique_events(events, delay)
    days = once.groupBy(F.window("ts", "1 day"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum(_amount(F.col("value"))).alias("total")
    )
    return days.select(F.col("window.start").cast("date").alias("day"), "event_type", "events", "total")


def user_sessions(events: DataFrame, gap: str = GAP, delay: str = DELAY) -> DataFrame:
    """user_id, started, ended, events and total of closed sessions, runs of events at most `gap` apart.

    A session ends with its last event; it is closed when the watermark has passed that by `gap`.
    """
    once = unique_events(events, delay)
    sessions = once.groupBy(F.session_window("ts", gap), "user_id").agg(
        F.max("ts").alias("ended"), F.count(F.lit(1)).alias("events"), F.sum(_amount(F.col("value"))).alias("total")
    )
    return sessions.select("user_id", F.col("session_window.start").alias("started"), "ended", "events", "total")


def append_available(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take in all files that are there, append what closed to Parquet under `path`, and stop."""
    query = result.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    query = query.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def late_events(query: StreamingQuery) -> int:
    """Events the last run of a query dropped behind the watermark, as its duplicates' operator counted them."""
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
        if state["operatorName"] == "dedupeWithinWatermark"
    )


def closed(spark: SparkSession, source: str, result: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """Run `result` over the files of `source` and read what it appended under `path`."""
    events = result(read_events(spark, source))
    append_available(events, f"{path}/closed", f"{path}/checkpoint")
    return spark.read.schema(events.schema).parquet(f"{path}/closed")
