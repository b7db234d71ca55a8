"""Sharding by extendible hashing: a directory over the leading bits of a hash of the doc_id.

A bucket holds the rows that agree in its leading bits. Starting from the whole table, only
buckets above the byte limit split on one more bit, until each fits. Bytes are summed once per
BITS-bit prefix (an aggregate with map-side combine); the sums of shorter prefixes follow from that,
and a row's bucket is the shortest prefix of its hash that fits. No row is moved to decide.

Rows whose whole prefix agrees cannot be split by bits. Such buckets, if they are still too large,
become overflow pages: rows above half the limit have pages of their own, and a running sum of
bytes deals the others into pages within the limit, in as many tasks as there are rows for.

A shard is (shard, page): the first BITS-bit prefix of its bucket, and 0 or the page. Only a single
row larger than the limit exceeds it. Null or empty text has 0 bytes; a null doc_id hashes as
empty text; repeated rows are kept. An empty table has an empty directory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.llm.common import grown
from ledgerlark.operators.ranking import running_total
from ledgerlark.session import Staging, tune

BITS, HALF = 24, 12
SHARD_BYTES = 1 << 20


def prefix(doc_id: str = "doc_id") -> Column:
    digits = F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def text_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long")


def _bucket(bits: Column, depth: Column | int) -> Column:
    """The first prefix of the bucket of `depth` leading bits that holds a prefix."""
    cut = F.lit(BITS) - (F.lit(depth) if isinstance(depth, int) else depth)
    return F.call_function("shiftleft", F.call_function("shiftright", bits, cut), cut)


def _sums(rows: DataFrame, depths: range) -> DataFrame:
    """Bytes and rows of every bucket of these depths that holds rows of (prefix, bytes, docs)."""
    paths = rows.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths])))
    return paths.groupBy("depth", _bucket(F.col("prefix"), F.col("depth")).alias("shard")).agg(
        F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs")
    )


def directory(docs: DataFrame, work: Staging, limit: int = SHARD_BYTES) -> DataFrame:
    """prefix -> shard, depth (leading bits), shard_bytes, shard_docs, for every prefix that occurs."""
    sums = work.table(
        docs.select(prefix().alias("prefix"), text_bytes().alias("bytes")).groupBy("prefix")
        .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs")),
        "sums",
    )
    top = sums.groupBy(_bucket(F.col("prefix"), HALF).alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
    shallow = work.table(_sums(top, range(HALF + 1)), "shallow")
    # Only what is still too large at half the bits is looked at with more of them.
    large = shallow.where((F.col("depth") == HALF) & (F.col("shard_bytes") > limit)).select(F.col("shard").alias("_top"))
    deeper = sums.withColumn("_top", _bucket(F.col("prefix"), HALF)).join(large, "_top", "left_semi").drop("_top")
    buckets = work.table(shallow.union(_sums(deeper, range(HALF + 1, BITS + 1))), "buckets")
    split = (F.col("shard_bytes") > limit) & (F.col("depth") < BITS)
    parents = buckets.where(split).select((F.col("depth") + 1).alias("depth"), F.col("shard").alias("_parent"))
    leaves = buckets.where(~split).withColumn("_parent", F.when(F.col("depth") > 0, _bucket(F.col("shard"), F.col("depth") - 1)))
    root = leaves.where("depth = 0").drop("_parent")
    leaves = work.table(leaves.join(parents, ["depth", "_parent"], "left_semi").select(*root.columns).union(root), "leaves")
    # At most BITS + 1 numbers.
    depths = sorted(r["depth"] for r in leaves.select("depth").distinct().collect())
    if not depths:
        return leaves.select(F.col("shard").alias("prefix"), "shard", "depth", "shard_bytes", "shard_docs")
    found = sums.select("prefix", F.explode(F.array(*[F.lit(d) for d in depths])).alias("depth"))
    found = found.withColumn("shard", _bucket(F.col("prefix"), F.col("depth")))
    return found.join(grown(leaves), ["depth", "shard"]).select("prefix", "shard", "depth", "shard_bytes", "shard_docs")


def assign_shards(docs: DataFrame, work: Staging, limit: int = SHARD_BYTES) -> DataFrame:
    """`docs` with shard, page, depth, bytes and shard_bytes (of all pages of the shard together).

    Columns of these names in `docs` are replaced.
    """
    spark = tune(docs.sparkSession)
    own = ("shard", "page", "depth", "bytes", "shard_bytes", "_prefix")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in own])
    shards = work.table(directory(docs, work, limit), "directory")
    # The directory has an entry for every prefix that occurs, so it grows with the table.
    entries = grown(shards.select(F.col("prefix").alias("_prefix"), "shard", "depth", "shard_bytes"))
    joined = docs.withColumn("_prefix", prefix()).withColumn("bytes", text_bytes()).join(entries, "_prefix")
    too_large = (F.col("shard_bytes") > limit) & (F.col("depth") == BITS)
    columns = [*docs.columns, "shard", "page", "depth", "bytes", "shard_bytes"]
    plain = joined.where(~too_large).withColumn("page", F.lit(0).cast("long")).select(*columns)
    if shards.where(too_large).isEmpty():
        return plain
    held = work.table(joined.where(too_large).withColumn("_row", F.monotonically_increasing_id()), "overflow")
    half = limit // 2
    alone = held.where(F.col("bytes") > half).withColumn("page", -1 - F.col("_row"))
    small = held.where(F.col("bytes") <= half).select("_row", "_prefix", "bytes")
    dealt = running_total(small, ["_prefix", "_row"], "bytes", name="_upto")
    dealt = dealt.select("_row", (F.floor((F.col("_upto") - F.col("bytes")) / max(half, 1)) + 1).cast("long").alias("page"))
    paged = held.join(work.table(dealt, "pages"), "_row")
    return plain.union(alone.select(*columns)).union(paged.select(*columns))


SHARD_SQL = f"""
WITH docs AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {BITS // 4}) AS BIGINT) AS prefix
  FROM documents
), buckets AS (
  SELECT depth, (prefix >> CAST({BITS} - depth AS INT)) << CAST({BITS} - depth AS INT) AS shard, CAST(sum(bytes) AS BIGINT) AS shard_bytes
  FROM docs, range(0, {BITS} + 1) t(depth) GROUP BY ALL
), placed AS (
  SELECT d.doc_id, d.bytes, b.shard, b.depth, b.shard_bytes,
    row_number() OVER (PARTITION BY d.doc_id ORDER BY b.depth) AS choice
  FROM docs d JOIN buckets b ON b.shard = (d.prefix >> CAST({BITS} - b.depth AS INT)) << CAST({BITS} - b.depth AS INT)
  WHERE b.shard_bytes <= {SHARD_BYTES} OR b.depth = {BITS}
)
SELECT doc_id, shard, CAST(0 AS BIGINT) AS page, CAST(depth AS INT) AS depth, bytes, shard_bytes FROM placed WHERE choice = 1
"""
