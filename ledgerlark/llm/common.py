"""What several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.session import Staging


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def grown(side: DataFrame) -> DataFrame:
    """Marks a join side that grows with the corpus: it is sorted and merged, never broadcast."""
    return side.hint("merge")


def by_batch(function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch]):
    """A `mapInArrow` function from one that takes a batch and returns or yields batches."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out

    return run


def _edge_sum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, work: Staging, name: str) -> DataFrame:
    """Connected components of the edges (a, b): one row (node, root) for every node but the roots.

    Each round turns neighbourhoods into stars around their smallest node, first for the larger
    neighbours and then for the smaller ones, until nothing changes: a logarithmic number of
    rounds. Minima are aggregates with map-side combine and are written before they are joined
    back, so adaptive execution can split the rows of a node with very many neighbours.
    """
    now = work.table(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0"
    )
    state, turn = _edge_sum(now), 0
    while state[0]:
        both = now.union(now.select("v", "u"))
        least = work.table(both.groupBy("u").agg(F.min("v").alias("m")), f"{name}-large-{turn}")
        larger = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        )
        larger = work.table(larger, f"{name}-mid-{turn}")
        least = work.table(larger.groupBy("u").agg(F.min("v").alias("m")), f"{name}-small-{turn}")
        moved = larger.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        turn += 1
        now = work.table(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{turn}")
        before, state = state, _edge_sum(now)
        work.drop(f"{name}-large-{turn - 1}", f"{name}-mid-{turn - 1}", f"{name}-small-{turn - 1}", f"{name}-{turn - 1}")
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
