"""Orders and their lines laid out together, so that joins on the order need no shuffle.

Both tables are staged once in the same number of buckets of the order key; every later join or sum
on that key reads bucket by bucket. A bucket is one task's work, which a hot order would make
uneven, so orders with more than a `HOT`th of an average bucket's lines are laid out apart: their
lines in as many pieces as there are buckets, whatever their key. There are fewer than
`HOT * buckets` such orders, so their headers are broadcast with a proven bound.

Headers must have one row per key, as cleaned orders have; `colocate` refuses hot keys that repeat.
Lines without a key, or with one that has no header, stay lines: a left join keeps them. Orders
without a key join nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.session import delete_path, stage, staging_path, tune

#: An order is hot if its lines fill more than this part of an average bucket.
HOT = 4


@dataclass(frozen=True)
class Colocated:
    """The layout: `headers` and `lines` in buckets of `key`, and what belongs to hot keys."""

    key: str
    buckets: int
    headers: DataFrame
    lines: DataFrame
    hot_headers: DataFrame
    hot_lines: DataFrame


def _bucketed(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """Stage `df` in buckets, one sorted file each. The catalog's entry goes at once, the files stay."""
    spark = df.sparkSession
    path, table = staging_path(spark, name), f"ledgerlark_{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    try:
        return spark.table(table)
    except BaseException:
        delete_path(spark, path)
        raise
    finally:
        spark.sql(f"DROP TABLE {table}")


def colocate(orders: DataFrame, lines: DataFrame, key: str = "order_id", buckets: int | None = None) -> Colocated:
    """Lay out both tables by `key`; `buckets` is the number of shuffle partitions if not given."""
    spark = tune(orders.sparkSession)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = stage(lines.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")), "line-counts")
    total = sizes.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    hot = stage(sizes.where(F.col("_rows") * F.lit(HOT * buckets) > F.lit(total)).select(F.col(key).alias("_key")), "hot-orders")
    known = F.broadcast(hot)
    heads = orders.join(known, F.col(key) == F.col("_key"), "left_semi")
    hot_headers = stage(heads, "hot-headers")
    if not hot_headers.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"orders must have one row per {key}")
    same = F.col(key).eqNullSafe(F.col("_key"))
    return Colocated(
        key, buckets,
        _bucketed(orders.join(known, F.col(key) == F.col("_key"), "left_anti"), key, buckets, "headers"),
        _bucketed(lines.join(known, same, "left_anti"), key, buckets, "lines"),
        hot_headers,
        stage(lines.join(known, same, "left_semi").repartition(buckets), "hot-lines"),
    )


def with_headers(placed: Colocated, how: str = "inner", columns: list[str] | None = None) -> DataFrame:
    """Lines with columns of their header: inner, left, left_semi or left_anti join, without a shuffle."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"no such join of lines and headers: {how}")

    def wanted(df: DataFrame) -> DataFrame:
        return df if columns is None else df.select(placed.key, *[c for c in columns if c != placed.key])

    cold = placed.lines.join(wanted(placed.headers).hint("merge"), placed.key, how)
    return cold.union(placed.hot_lines.join(F.broadcast(wanted(placed.hot_headers)), placed.key, how))


def with_sums(placed: Colocated, **sums: Column) -> DataFrame:
    """Every header with aggregates of its lines, null where it has none; only hot lines are shuffled.

    Sums of hot lines are combined in each task first, so a hot order costs one row a task.
    """
    measures = [c.alias(name) for name, c in sums.items()]
    cold = placed.lines.groupBy(placed.key).agg(*measures)
    hot = placed.hot_lines.groupBy(placed.key).agg(*measures)
    return placed.headers.join(cold.hint("merge"), placed.key, "left").union(
        placed.hot_headers.join(F.broadcast(hot), placed.key, "left")
    )
