"""Aggregates that recur in the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, NumericType, StringType

from ledgerlark.functions.encode import place
from ledgerlark.functions.numeric import percent, whole_division
from ledgerlark.operators.ranking import exact_median, exact_quantiles, long_values


def conditional_sums(df: DataFrame, keys: list[str], sums: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Several sums over different subsets of the rows in one pass; 0 where none match."""
    return df.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(where, value)), F.lit(0)).alias(name)
            for name, (where, value) in sums.items()
        ]
    )


def masked_median(df: DataFrame, col: str, where: Column) -> DataFrame:
    return exact_median(df.where(where), col)


def frequency(df: DataFrame, col: str, order: list[str] | None = None, name: str = "count") -> DataFrame:
    """Rows per non-null value, most frequent first; or in a given order, null where absent."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
    if order is None:
        return counts.orderBy(F.desc(name), col)
    spine = df.sparkSession.createDataFrame([(v,) for v in order], f"`{col}` string")
    return spine.join(counts, col, "left").orderBy(place(F.col(col), order))


def with_share(df: DataFrame, part: str, name: str, places: int = 1) -> DataFrame:
    """Percent of the column's total. For results with few rows: the window is not partitioned."""
    return df.withColumn(name, percent(F.col(part), F.sum(part).over(Window.partitionBy()), places))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, from one aggregate over the table."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column", "nulls")


def describe_numbers(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max per column, all exact."""
    long = long_values(df, cols)
    value = F.col("value").cast("double")
    stats = long.groupBy("column").agg(
        F.count("value").alias("count"),
        (F.sum("value").cast("double") / F.nullif(F.count("value").cast("double"), F.lit(0.0))).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).groupBy("column").pivot("q", [0.25, 0.5, 0.75]).agg(
        F.max("value")
    )
    quartiles = quartiles.toDF("column", "q25", "q50", "q75")
    return stats.join(F.broadcast(quartiles), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def describe_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, distinct values, most frequent value (smallest on ties) and its frequency."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    return counts.groupBy("column").agg(
        F.sum("rows").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("rows"), F.col("value"))).alias("top"),
        F.max("rows").alias("freq"),
    )


def describe_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, min, quartiles and max per date column; a quartile between two days is the earlier."""
    days = df.select(*[F.unix_date(c).alias(c) for c in cols])
    found = describe_numbers(days, cols)
    return found.select(
        "column", "count",
        *[F.date_from_unix_date(F.floor(c).cast("int")).alias(c) for c in ("min", "q25", "q50", "q75", "max")],
    )


def describe(df: DataFrame) -> dict[str, DataFrame]:
    """The summaries that fit the columns: "numbers", "text" and "dates"."""
    kinds = {"numbers": NumericType, "text": StringType, "dates": DateType}
    cols = {k: [f.name for f in df.schema if isinstance(f.dataType, t)] for k, t in kinds.items()}
    makers = {"numbers": describe_numbers, "text": describe_text, "dates": describe_dates}
    return {k: makers[k](df, c) for k, c in cols.items() if c}


def monthly_series(df: DataFrame, day: str, value: str, name: str = "total") -> DataFrame:
    """Sum per calendar month; months without rows between the first and the last give 0."""
    sums = df.groupBy(F.trunc(day, "MM").alias("month_start")).agg(F.sum(value).alias("_sum"))
    months = sums.agg(
        F.explode(F.sequence(F.min("month_start"), F.max("month_start"), F.expr("interval 1 month"))).alias("month_start")
    )
    return (
        months.join(sums, "month_start", "left")
        .select("month_start", F.coalesce("_sum", F.lit(0)).alias(name))
        .orderBy("month_start")
    )


def bin_index(col: str, low: Column, high: Column, bins: int, floating: bool = False) -> Column:
    """Equal-width bin 0..bins-1 over [low, high], the last closed.

    Whole numbers and decimals are binned exactly. For floating columns the guess from the
    division is corrected by the edges themselves.
    """
    flat = F.lit(bins // 2).cast("long")
    x, span = F.col(col), F.nullif(high - low, F.lit(0))
    if floating:
        guess = F.least(F.floor((x - low) * (bins / span)), F.lit(bins - 1).cast("long"))
        edge, after = low + span / bins * guess, low + span / bins * (guess + 1)
        steps = F.when(x < edge, guess - 1).when(x >= after, guess + 1).otherwise(guess)
    else:
        steps = whole_division((x - low) * bins, span)
    return F.when(F.col(col).isNotNull(), F.least(F.coalesce(steps, flat), F.lit(bins - 1).cast("long")))


def _floating(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (DoubleType, FloatType))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """(bin, low, high, count) for all equal-width bins between the column's extremes.

    A constant column has bins from half a unit below it to half a unit above.
    """
    # One subquery: Spark merges scalar subqueries over the same rows.
    ends = df.agg(F.min(col).alias("low"), F.max(col).alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    counts = (
        df.where(F.col(col).isNotNull())
        .select(col, low.alias("_low"), high.alias("_high"))
        .groupBy(bin_index(col, F.col("_low"), F.col("_high"), bins, _floating(df, col)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    slack = F.when(low == high, 0.5).otherwise(0.0)
    start, width = low.cast("double") - slack, (high.cast("double") - low.cast("double") + 2 * slack) / bins
    spine = df.sparkSession.range(bins).select(
        F.col("id").alias("bin"), start.alias("_low"), width.alias("_width")
    )
    return spine.join(counts, "bin", "left").select(
        "bin",
        (F.col("_low") + F.col("_width") * F.col("bin")).alias("low"),
        (F.col("_low") + F.col("_width") * (F.col("bin") + 1)).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    ).orderBy("bin")


def binned_pairs(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """A point cloud as counts per cell of an equal-width grid."""
    ends = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    edges = ["x0", "x1", "y0", "y1"]
    x0, x1, y0, y1 = (F.col(c) for c in edges)
    return df.select(x, y, *[ends.select(c).scalar().alias(c) for c in edges]).groupBy(
        bin_index(x, x0, x1, bins, _floating(df, x)).alias("x_bin"),
        bin_index(y, y0, y1, bins, _floating(df, y)).alias("y_bin"),
    ).agg(F.count(F.lit(1)).alias("points"))
