"""From raw documents to shards of a training mix, one operator a stage.

Each stage is (name, function of (spark, docs, sf_dir)) and works on all its predecessor kept. Its
result is written as Parquet and read again as the next stage's `docs`. All stages but the last
return the columns of documents; mixing repeats the rows that the mix takes more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.llm.common import documents, grown, table
from ledgerlark.llm.decontaminate import leaks
from ledgerlark.llm.languages import UNKNOWN, held_out, identify, learn, unlike
from ledgerlark.llm.mixing import copies, mixing_plan
from ledgerlark.llm.near_dups import near_duplicates
from ledgerlark.llm.sharding import assign_shards
from ledgerlark.session import Staging

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents and `_key`: the doc_id, or where there is none a number above all ids by its text."""
    own = F.lit(1 << 62) + F.pmod(F.xxhash64("text", "source"), F.lit(1 << 60))
    return docs.select(*COLUMNS, F.coalesce(F.col("doc_id").cast("long"), own).alias("_key"))


def _by_key(docs: DataFrame) -> DataFrame:
    """`_keyed` documents as an operator takes them."""
    return docs.withColumn("doc_id", F.col("_key")).drop("_key")


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and texts unlike every language learned from the labelled ones.

    Null and empty texts have no letters. How unlike a text must be depends on how many trigrams
    speak for it (`languages.unlike`). An empty table stays empty; where no row has a language,
    nothing is learned and nothing is kept.
    """
    marked = docs.select(*COLUMNS)
    said = identify(marked, learn(marked.where(~held_out())), list(COLUMNS))
    return said.where((F.col("lang_pred") != UNKNOWN) & ~unlike()).select(*COLUMNS)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near-duplicates, and of equal rows of an id one.

    Rows without doc_id take part behind all others; equal texts of one source among them are one
    document. Rows of one doc_id with different texts are versions of one document and stay together.
    """
    work = Staging(spark, "pipeline-dedup")
    keyed = _keyed(docs)
    found = near_duplicates(_by_key(keyed), work).groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    found = work.table(found.where("kept").select(F.col("doc_id").alias("_key"), "rows"), "kept")
    repeated = found.where("rows > 1").select("_key")
    kept = keyed.join(grown(found.where("rows = 1").select("_key")), "_key", "left_semi")
    if not repeated.isEmpty():
        kept = kept.union(keyed.join(repeated, "_key", "left_semi").dropDuplicates(["_key", "text"]).select(*kept.columns))
    return kept.select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, in any of the rows of their doc_id.

    Rows without doc_id are judged each by their own text. An empty benchmark drops nothing.
    """
    keyed = _keyed(docs)
    found = leaks(_by_key(keyed), table(spark, sf_dir, "benchmark"), Staging(spark, "pipeline-leaks"))
    return keyed.join(grown(found.select(F.col("doc_id").alias("_key")).distinct()), "_key", "left_anti").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source to its target: rows the mix leaves go, rows it takes twice are there twice.

    A null source is a source; rows of one doc_id and source are taken equally often.
    """
    keyed = _keyed(docs)
    sized, plan = mixing_plan(_by_key(keyed), Staging(spark, "pipeline-mix"))
    taken = sized.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    taken = taken.withColumn("_copies", copies()).where("_copies > 0")
    taken = taken.select(F.col("doc_id").alias("_id"), F.col("source").alias("_of"), "_copies").distinct()
    rows = keyed.join(grown(taken), (F.col("_key") == F.col("_id")) & F.col("source").eqNullSafe(F.col("_of")))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*COLUMNS)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard of each row; rows without doc_id share one prefix and are parted by pages if they must."""
    return assign_shards(docs.select(*COLUMNS), Staging(spark, "pipeline-shards"))


STAGES = [
    ("language", identified),
    ("near_duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of `sf_dir`; the result is a written table."""
    work = Staging(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = work.table(stage(spark, docs, sf_dir), name)
    return docs


#: Learned prototypes and MinHash orders are beyond SQL; the tests hold the run against brute force.
ORACLE_SQL = None
