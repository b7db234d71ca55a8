"""Order-based operators that never bring a whole table into one task.

A global order is a range shuffle followed by a sort of each partition. The sorted rows are
written once; from then on `_at` (partition number in the high bits, position in the low 33)
is a fixed column, and a rank or running total needs only one small row per partition.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

from ledgerlark.functions.numeric import whole_division
from ledgerlark.session import stage

_POSITION_BITS = 33
#: Values of a quantile's last bracket, and the sketch behind brackets: its rank error is about half the slack.
QUANTILE_ROWS, SKETCH_SIZE, SKETCH_SLACK = 1_000_000, 4096, 0.002


def _columns(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def _laid_out(df: DataFrame, order: list, name: str) -> DataFrame:
    keys = _columns(order)
    ordered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return stage(ordered, name).withColumn("_part", F.shiftright("_at", _POSITION_BITS).cast("int"))


def _with_starts(laid: DataFrame, within: list[str], measure: Column) -> DataFrame:
    """Add `_start`, the sum of `measure` over the partitions before, and `_first`.

    The joined side has one row per partition and group that meet: with groups it may grow with
    the data, so only without them, at one row per partition, is it marked for broadcast.
    """
    pieces = laid.groupBy("_part", *within).agg(measure.alias("_sum"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        F.col("_part").alias("_p"),
        *[F.col(c).alias(f"_w_{c}") for c in within],
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
        "_first",
    )
    match = F.col("_part") == F.col("_p")
    for c in within:
        match = match & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    return laid.join(starts if within else F.broadcast(starts), match).drop("_p", *[f"_w_{c}" for c in within])


def global_rank(df: DataFrame, order: list, within: list[str] | None = None, name: str = "rank") -> DataFrame:
    """Add a unique rank 1..n by `order`, restarting for each value of `within`.

    `order` must end in a unique key; it decides ties.
    """
    within = within or []
    laid = _laid_out(df, [*within, *order], "rank")
    placed = _with_starts(laid, within, F.count(F.lit(1)))
    return placed.withColumn(name, F.col("_start") + F.col("_at") - F.col("_first") + 1).drop(
        "_at", "_part", "_start", "_first"
    )


def running_total(
    df: DataFrame, order: list, weight: str, within: list[str] | None = None, name: str = "running"
) -> DataFrame:
    """Add the inclusive running sum of `weight` by `order`, restarting for each `within`."""
    within = within or []
    laid = _laid_out(df, [*within, *order], "running")
    placed = _with_starts(laid, within, F.sum(weight))
    inside = Window.partitionBy("_part", *within).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return placed.withColumn(name, F.col("_start") + F.sum(weight).over(inside)).drop(
        "_at", "_part", "_start", "_first"
    )


def quantile_score(rank: Column, rows: Column, buckets: int = 5, ascending: bool = True) -> Column:
    """Equal-frequency score 1..buckets of a unique rank among `rows` rows.

    Interval edges are the linear quantiles of 1..n, closed on the right, so the score is
    ceil(buckets * (rank - 1) / (rows - 1)), at least 1. This differs from `ntile`.
    """
    span = F.greatest(rows - 1, F.lit(1))
    score = F.greatest(F.lit(1), whole_division(buckets * (rank - 1) + span - 1, span))
    if not ascending:
        score = F.when(rows == 1, F.lit(1)).otherwise(buckets + 1 - score)
    return score.cast("int")


def keep_first(df: DataFrame, key: str, arrival: list[str], copies: str | None = None) -> DataFrame:
    """One row per key (null keys count as equal): the first by `arrival`, then by all columns.

    An aggregate, not a window: each map task sends one row per key, so a key with many copies
    costs no more than any other. `copies` names an optional column with the group's size.
    """
    rest = [c for c in df.columns if c != key and c not in arrival]
    picked = df.groupBy(key).agg(
        F.min(F.struct(*arrival, *rest)).alias("_row"), F.count(F.lit(1)).alias(copies or "_copies")
    )
    fields = [F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns]
    return picked.select(*fields, *([copies] if copies else []))


def top_k(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first `n` rows by `order`; end it in a unique key to fix ties."""
    return df.orderBy(*order).limit(n)


_INTEGER_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def common_number(df: DataFrame, cols: list[str]) -> DataType:
    """One type for number columns: double if any of them is floating, else a decimal of the widest scale.

    A decimal has 38 digits; where whole and decimal digits of different columns do not fit
    together, the columns must be ranked apart.
    """
    kinds = [df.schema[c].dataType for c in cols]
    if any(isinstance(k, (DoubleType, FloatType)) for k in kinds):
        return DoubleType()
    scale = max(k.scale if isinstance(k, DecimalType) else 0 for k in kinds)
    whole = max(k.precision - k.scale if isinstance(k, DecimalType) else _INTEGER_DIGITS[k.simpleString()] for k in kinds)
    if whole + scale > 38:
        raise ValueError(f"{cols} need {whole} digits before and {scale} after the point: rank them apart")
    return DecimalType(whole + scale, scale)


def long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value) of number columns, in their common type; no digit is lost."""
    common = common_number(df, cols)
    return df.select(*[F.col(c).cast(common).alias(c) for c in cols]).unpivot([], cols, "column", "value")


@dataclass
class _Bracket:
    """Where an order statistic lies: of `n` values `below` are less than `low`, `inside` in low..high."""

    column: str
    q: float
    n: int
    low: float
    high: float
    below: int
    inside: int
    settled: bool = False

    @property
    def spot(self) -> float:
        return (self.n - 1) * self.q

    def holds(self, value: Column) -> Column:
        return (value >= F.lit(self.low)) & (value <= F.lit(self.high))


def _narrowed(wide: DataFrame, brackets: list[_Bracket]) -> None:
    """Two passes: a sketch of what each bracket holds proposes a narrower one, counts accept or refuse it."""
    sketches = wide.agg(*[
        F.kll_sketch_agg_double(F.when(b.holds(F.col(b.column)), F.col(b.column)), F.lit(SKETCH_SIZE)).alias(str(k))
        for k, b in enumerate(brackets)
    ])
    ends = []
    for k, b in enumerate(brackets):
        for position, off in ((math.floor(b.spot), -SKETCH_SLACK), (math.ceil(b.spot), SKETCH_SLACK)):
            rank = min(max((position - b.below + 0.5) / b.inside + off, 0.0), 1.0)
            ends.append(F.kll_sketch_get_quantile_double(F.col(str(k)), F.lit(rank)))
    found = sketches.select(F.array(*ends).alias("ends")).first()["ends"]
    proposed = [(max(b.low, found[2 * k]), min(b.high, found[2 * k + 1])) for k, b in enumerate(brackets)]
    counts = wide.agg(*[
        c for k, (b, (low, high)) in enumerate(zip(brackets, proposed, strict=True)) for c in (
            F.count_if(F.col(b.column) < F.lit(low)).alias(f"b{k}"),
            F.count_if((F.col(b.column) >= F.lit(low)) & (F.col(b.column) <= F.lit(high))).alias(f"i{k}"),
        )
    ]).first()
    for k, (b, (low, high)) in enumerate(zip(brackets, proposed, strict=True)):
        below, inside = counts[f"b{k}"], counts[f"i{k}"]
        b.settled = inside > b.inside / 2
        if below <= math.floor(b.spot) and math.ceil(b.spot) < below + inside:
            b.low, b.high, b.below, b.inside = low, high, below, inside
        else:
            b.settled = True


def exact_quantiles(df: DataFrame, cols: list[str], probabilities: list[float], rows: int = QUANTILE_ROWS) -> DataFrame:
    """Linear-interpolated quantiles per column: (column, n, q, value). Columns without a value have none.

    A KLL sketch brackets every quantile and a count checks the bracket, again and again, each time
    over about a five-hundredth of the values before, until a bracket holds at most `rows` of them.
    Only what the last brackets hold is sorted. Passes read the columns alone and shuffle one row
    per task; what reaches the driver are the brackets. A bracket that cannot be narrowed, as one
    with one frequent value, is counted value by value and ordered by a range shuffle.
    """
    common = common_number(df, cols)
    exact = df.select(*[F.col(c).cast(common).alias(c) for c in cols])
    # Brackets are compared as doubles, which keep the order of the exact values.
    wide = exact.select(*[F.col(c).cast("double").alias(c) for c in cols])
    ends = wide.agg(*[
        f(c).alias(f"{name}{i}") for i, c in enumerate(cols) for name, f in (("n", F.count), ("l", F.min), ("h", F.max))
    ]).first()
    brackets = [
        _Bracket(c, float(q), ends[f"n{i}"], ends[f"l{i}"], ends[f"h{i}"], 0, ends[f"n{i}"])
        for i, c in enumerate(cols) if ends[f"n{i}"] for q in probabilities
    ]
    while wanted := [b for b in brackets if b.inside > rows and b.low < b.high and not b.settled]:
        _narrowed(wide, wanted)
    if not brackets:
        return df.sparkSession.createDataFrame([], "column string, n long, q double, value double")
    held = [
        F.when(b.holds(F.col(b.column).cast("double")), F.struct(
            F.lit(b.column).alias("column"), F.lit(b.n).cast("long").alias("n"), F.lit(b.q).alias("q"), F.lit(b.spot).alias("spot"),
            F.lit(b.below).cast("long").alias("below"), F.col(b.column).alias("value"),
        )) for b in brackets
    ]
    kept = exact.select(F.explode(F.filter(F.array(*held), lambda x: x.isNotNull())).alias("x")).select("x.*")
    counts = kept.groupBy("column", "n", "q", "spot", "below", "value").agg(F.count(F.lit(1)).alias("rows"))
    if all(b.inside <= rows for b in brackets):
        upto = Window.partitionBy("column", "q").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        summed = counts.withColumn("running", F.sum("rows").over(upto))
    else:
        summed = running_total(counts, ["value"], "rows", within=["column", "q"])
    # A distinct value covers the positions running - rows .. running - 1.
    first, last, spot = F.col("below") + F.col("running") - F.col("rows"), F.col("below") + F.col("running"), F.col("spot")
    low, high = F.floor("spot"), F.ceil("spot")
    weight = F.when((low >= first) & (low < last), F.when(low == high, 1.0).otherwise(high - spot)).otherwise(0.0) + F.when(
        (high >= first) & (high < last) & (low < high), spot - low
    ).otherwise(0.0)
    met = ((low >= first) & (low < last)) | ((high >= first) & (high < last))
    return summed.where(met).groupBy("column", "n", "q").agg(F.sum(F.col("value").cast("double") * weight).alias("value"))


def exact_median(df: DataFrame, col: str) -> DataFrame:
    """One row with the exact median of a column, null where it has no value."""
    found = exact_quantiles(df, [col], [0.5])
    return found.agg(F.max("value").alias("median"))
