"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Sources, by code point and null last, weigh WEIGHTS in turn and share `share` times all words. A
target stops at `most` times its source; the excess goes to the other sources by weight until no
target is above. In closed form: with sources ordered by limit per weight, the first at which an
even level of words per weight stays within its limit fixes that level.

A source's whole multiples (epochs) of its words are taken complete. The rest is a weighted sample
without replacement: every document draws an exponential key, minus the logarithm of a uniform
number over its quality weight, and the smallest keys are taken as far as their running sum of
words stays within what is left. The last place goes to the one untaken document whose size comes
nearest to the words still missing, if that brings the source nearer to its target.

The running sum needs no sort of a source: words are summed by RANGES ranges of the key, the range
in which the budget ends is found from those sums, at most RANGES rows a source, and only that
range's documents are ordered.

The uniform number is the MD5 of the doc_id, so reruns agree. Null text has no words and is never
taken. Rows that repeat a doc_id are taken or left together, each counting its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.session import Staging, tune

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
RANGES = 16384
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality(size: str = "size", text: str = "text") -> Column:
    """2 for texts of 20 words or more, 3 to 12 characters a word with the gaps; else 1."""
    n = F.length(text)
    plain = (F.col(size) >= 20) & (n >= 3 * F.col(size)) & (n <= 12 * F.col(size))
    return F.when(plain, F.lit(2.0)).otherwise(F.lit(1.0))


def key(doc_id: str = "doc_id", weight: str = "weight") -> Column:
    """1 - exp(-exponential key), which has the key's order: 1 - u ** (1 / weight)."""
    digits = F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, 12)
    uniform = (F.conv(digits, 16, 10).cast("double") + 1) / F.lit(float(2**48))
    return 1 - F.pow(uniform, 1 / F.col(weight))


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target, epochs and left (words beyond whole epochs); one row per source."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    sizes = sizes.withColumn("share", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    sizes = sizes.withColumn("limit", F.col("source_size") * F.lit(float(most)))
    by_limit = Window.orderBy(F.col("limit") / F.col("share"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    budget = F.lit(share) * F.sum("source_size").over(everything)
    full = F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_share = F.sum("share").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    levels = sizes.withColumn("level", (budget - full) / open_share)
    fits = F.when(F.col("level") * F.col("share") <= F.col("limit"), F.struct(F.col("limit") / F.col("share"), F.col("level").alias("level")))
    target = F.least("limit", F.min(fits).over(everything)["level"] * F.col("share"))
    levels = levels.withColumn("target", F.coalesce(target, F.col("limit")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return levels.select(
        "source", "source_size", "target", epochs.alias("epochs"),
        (F.col("target") - epochs * F.col("source_size")).alias("left"),
    )


def mixing_plan(docs: DataFrame, work: Staging, weight: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, size, source, key, bucket of every row; what is taken of every source).

    `weight` is a positive number per row, `quality()` unless given.
    """
    tune(docs.sparkSession)
    sized = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"),
        *([weight.alias("weight")] if weight is not None else []),
    ).withColumn("size", words())
    if weight is None:
        sized = sized.withColumn("weight", quality())
    sized = sized.withColumn("key", key())
    bucket = F.least(F.floor(F.col("key") * RANGES), F.lit(RANGES - 1)).cast("int")
    sized = work.table(sized.select("doc_id", "source", "size", "key", bucket.alias("bucket")), "sized")
    targets = work.table(source_targets(sized), "targets")

    def same(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
        """Join on the source, null equal to null."""
        renamed = b.withColumnRenamed("source", "_source")
        return a.join(renamed, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")

    ranges = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    summed = same(ranges.withColumn("upto", F.sum("words").over(upto)), targets).where("upto > left")
    ends = work.table(
        summed.groupBy("source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("_end"))
        .select("source", F.col("_end.bucket").alias("end_bucket"), F.col("_end.before").alias("before")),
        "ends",
    )
    last = same(sized, ends).where("bucket = end_bucket").groupBy("source", "key", "doc_id").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    last = same(same(last.withColumn("inside", F.sum("words").over(order)), ends), targets).where("before + inside <= left")
    cuts = last.groupBy("source").agg(
        F.max(F.struct("key", "doc_id")).alias("_cut"), F.max("inside").alias("inside")
    )
    plan = same(same(targets, ends, "left"), cuts, "left").select(
        "source", "source_size", "target", "epochs", "left", "end_bucket",
        F.col("_cut.key").alias("cut_key"), F.col("_cut.doc_id").alias("cut_id"),
        (F.col("left") - F.coalesce("before", "source_size") - F.coalesce("inside", F.lit(0))).alias("missing"),
    )
    plan = work.table(plan, "plan")
    rest = same(sized.select("doc_id", "source", "size", "key", "bucket"), plan).where(~_chosen()).where("size > 0")
    nearness = F.abs(F.col("missing") - F.col("size"))
    near = (
        rest.where(nearness < F.col("missing")).groupBy("source", "key", "doc_id", "missing").agg(F.sum("size").alias("size"))
        .where(nearness < F.col("missing")).groupBy("source").agg(F.min(F.struct(nearness.alias("off"), "key", "doc_id")).alias("_near"))
        .select("source", F.col("_near.key").alias("near_key"), F.col("_near.doc_id").alias("near_id"))
    )
    return sized, work.table(same(plan, near, "left"), "mix")


def _chosen() -> Column:
    """Whether the sample's prefix of keys holds the row."""
    in_last = (F.col("key") < F.col("cut_key")) | ((F.col("key") == F.col("cut_key")) & (F.col("doc_id") <= F.col("cut_id")))
    none_left = F.col("end_bucket").isNull()
    chosen = none_left | (F.col("bucket") < F.col("end_bucket")) | ((F.col("bucket") == F.col("end_bucket")) & in_last)
    return F.coalesce(chosen & (F.col("left") > 0), F.lit(False))


def copies() -> Column:
    """How often the mix takes a row, by the columns of `mixing_plan`."""
    near = F.coalesce((F.col("key") == F.col("near_key")) & F.col("doc_id").eqNullSafe(F.col("near_id")), F.lit(False))
    return F.when(F.col("size") > 0, F.col("epochs") + (_chosen() | near).cast("long")).otherwise(F.lit(0).cast("long"))


def mix(docs: DataFrame, work: Staging, weight: Column | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (words, repeats counted) of every row."""
    sized, plan = mixing_plan(docs, work, weight)
    joined = sized.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    return joined.withColumn("copies", copies()).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


#: The same rows in DuckDB; the key's power is the square root or nothing, as weights are 2 or 1.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), keyed AS (
  SELECT doc_id, source, size,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 1) / 281474976710656.0::DOUBLE AS u,
    CASE WHEN size >= 20 AND length(text) >= 3 * size AND length(text) <= 12 * size THEN 2.0 ELSE 1.0 END AS weight
  FROM sized
), ranked AS (
  SELECT *, 1 - pow(u, 1 / weight::DOUBLE) AS key FROM keyed
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS share
  FROM ranked GROUP BY source
), limits AS (SELECT *, source_size * 2.0::DOUBLE AS lim FROM sources), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(lim) OVER (ORDER BY lim / share, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(share) OVER (ORDER BY lim / share, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM limits
), targets AS (
  SELECT source, source_size, least(lim, share * (SELECT arg_min(level, lim / share) FROM levels WHERE level * share <= lim)) AS target
  FROM levels
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets
), lefts AS (SELECT *, target - epochs * source_size AS remaining FROM budgets), running AS (
  SELECT r.*, source_size, target, epochs, remaining,
    sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id) AS upto
  FROM ranked r JOIN lefts l ON r.source IS NOT DISTINCT FROM l.source
), prefix AS (SELECT *, upto <= remaining AND remaining > 0 AS chosen FROM running), gaps AS (
  SELECT source, any_value(remaining) - coalesce(sum(size) FILTER (chosen), 0) AS missing FROM prefix GROUP BY source
), nearest AS (
  SELECT p.source, arg_min(doc_id, (abs(missing - size), key, doc_id)) AS near_id
  FROM prefix p JOIN gaps g ON p.source IS NOT DISTINCT FROM g.source
  WHERE NOT chosen AND size > 0 AND abs(missing - size) < missing GROUP BY p.source
)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN size > 0 THEN size * (epochs + CAST(chosen OR coalesce(doc_id = near_id, false) AS BIGINT)) ELSE 0 END AS BIGINT) AS taken
FROM prefix p LEFT JOIN nearest n ON p.source IS NOT DISTINCT FROM n.source
"""
