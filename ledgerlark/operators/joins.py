"""Key joins.

No hint is given for tables that grow: Spark broadcasts a side only when its measured size is
under `spark.sql.autoBroadcastJoinThreshold`, and otherwise shuffles both sides, where adaptive
execution splits a hot key over several tasks (see `session.tune`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_star(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", columns: list[str] | None = None) -> DataFrame:
    """Join a fact to the wanted columns of a dimension with one row per key."""
    wanted = dim if columns is None else dim.select(key, *[c for c in columns if c != key])
    return fact.join(wanted, key, how)


def _keys(ref: DataFrame, key: str) -> DataFrame:
    """The distinct keys: combined before the shuffle, so a key repeated in `ref` costs one row per task."""
    return ref.select(key).distinct()


def keep_referenced(df: DataFrame, ref: DataFrame, key: str) -> DataFrame:
    return df.join(_keys(ref, key), key, "left_semi")


def orphans(df: DataFrame, ref: DataFrame, key: str) -> DataFrame:
    """Rows whose key is null or not in `ref`."""
    return df.join(_keys(ref, key), key, "left_anti")


def count_orphans(df: DataFrame, ref: DataFrame, key: str) -> DataFrame:
    """Number of rows whose key is null or not in `ref`; rows are counted per key before the join."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return orphans(counts, ref, key).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphans"))


def flag_absent(df: DataFrame, ref: DataFrame, key: str, name: str) -> DataFrame:
    """Add 1 where the key does not occur in `ref`, else 0."""
    seen = _keys(ref, key).withColumn("_seen", F.lit(True))
    return df.join(seen, key, "left").withColumn(name, F.col("_seen").isNull().cast("int")).drop("_seen")


def left_join_suffixed(left: DataFrame, right: DataFrame, key: str, suffix: str | None) -> DataFrame:
    """Left join where overlapping right columns get a suffix, or are left out if it is None."""
    overlap = [c for c in right.columns if c in left.columns and c != key]
    kept = [
        F.col(c).alias(c + suffix) if c in overlap else F.col(c)
        for c in right.columns
        if suffix is not None or c not in overlap
    ]
    return left.join(right.select(*kept), key, "left")
