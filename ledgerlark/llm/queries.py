"""The training-data operators as registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from ledgerlark.llm.alignment import align_tokenizers
from ledgerlark.llm.chat import CHAT_SQL, digests, format_chats
from ledgerlark.llm.common import documents, table
from ledgerlark.llm.decontaminate import leaks
from ledgerlark.llm.languages import held_out, identify, learn
from ledgerlark.llm.licenses import scan_licenses
from ledgerlark.llm.mixing import MIX_SQL, mix
from ledgerlark.llm.near_dups import near_duplicates
from ledgerlark.llm.neighbours import nearest
from ledgerlark.llm.personal import find_personal, personal_digest
from ledgerlark.llm.sharding import SHARD_SQL, assign_shards
from ledgerlark.llm.spelling import spelling_variants
from ledgerlark.llm.substrings import repeated_passages
from ledgerlark.llm.token_files import read_tokens, write_tokens
from ledgerlark.session import Staging


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), Staging(spark, "op1"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return assign_shards(docs, Staging(spark, "op2")).drop("text")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), Staging(spark, "op3"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir), Staging(spark, "op4"))[0]


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir), Staging(spark, "op5"))[0]


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", held_out())
    return identify(docs, learn(docs.where("not held_out")), ["doc_id", "held_out"])


def op7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), Staging(spark, "op7"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{Staging(spark, 'op8').root}/tokens"
    write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path)


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir), Staging(spark, "op9")).select("doc_id", "size", "source_size", "target", "taken")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one more whose texts are made of the template's own control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    work = Staging(spark, "op10")
    return digests(work.table(format_chats(rows.union(hard)).select("conv_id", "formatted", "mask", "identical"), "chats"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_digest(find_personal(documents(spark, sf_dir), ["doc_id"]))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align_tokenizers(documents(spark, sf_dir), Staging(spark, "op12"), *paths)[0]


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir), Staging(spark, "op13"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_duplicates, op2_shards, op3_nearest, op4_licenses, op5_repeated_passages, op6_language, op7_leaks, op8_token_files,
        op9_mix, op10_chat, op11_personal_data, op12_alignment, op13_spelling_variants,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLE_SQL = {"op2_shards": SHARD_SQL, "op9_mix": MIX_SQL, "op10_chat": CHAT_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
