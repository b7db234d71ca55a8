"""Keyed upserts from a stream of documents.

The target is a parquet table split into a fixed number of hash buckets of the key. A batch
rewrites only the buckets it touches. Setting the same fields again changes nothing, so a batch
that is replayed after a failure gives the same table.

The rewrite is Spark's dynamic overwrite of partitions: while a batch is written, a reader may find a
bucket empty or see some buckets new and others old, and after a failure the table is whole again
only when the batch was replayed. Read between batches, or keep the table in a format that has
transactions; this module adds none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.session import stage, staging_scope
from ledgerlark.sources.tables import path_exists, upsert

BUCKET = "_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_target(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Lay a table out for `upsert_stream`."""
    df.withColumn(BUCKET, bucket_of(key, buckets)).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def read_target(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def apply_batch(updates: DataFrame, path: str, key: str, order: list[str], buckets: int) -> None:
    """Merge one batch; its staged tables are gone when it ends."""
    with staging_scope(updates.sparkSession):
        _apply(updates, path, key, order, buckets)


def _apply(updates: DataFrame, path: str, key: str, order: list[str], buckets: int) -> None:
    spark = updates.sparkSession
    updates = stage(updates, "updates")
    if updates.isEmpty():
        return
    if path_exists(spark, path):
        current = spark.read.parquet(path)
        # At most `buckets` numbers, a setting of the table.
        touched = [r[0] for r in updates.select(bucket_of(key, buckets)).distinct().collect()]
        current = current.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    else:
        current = updates.limit(0)
    merged = stage(upsert(current, updates, key, order).withColumn(BUCKET, bucket_of(key, buckets)), "merged")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def upsert_stream(
    stream: DataFrame, path: str, key: str, order: list[str], checkpoint: str, buckets: int = 64
) -> StreamingQuery:
    """Apply everything that is there to the target, batch by batch, and stop."""

    def apply(batch: DataFrame, _: int) -> None:
        apply_batch(batch, path, key, order, buckets)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
