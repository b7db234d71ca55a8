"""Token ids in coded files: documents in ascending order, in segments that decode on their own.

The corpus is sorted by doc_id with a range shuffle. Each task tokenizes its range, closes every
document with an end id and codes runs of whole documents of about SEGMENT_IDS ids (`coder`). The
files are a Parquet table with one row per segment: range, segment, first and last doc_id, ids and
the coded bytes, which any reader of a Parquet file can decode without the others.

The tokenizer splits texts into words before it merges, so the library encodes each distinct piece
(`pieces.word_pieces`) only when it is not at hand, and the pieces' ids are joined. New words of letters
are written behind each other, with a blank or a line break before each, and encoded in one call; the
bytes that ids stand for tell where each word's begin. All else is encoded piece by piece; texts that
hold the string of one of the tokenizer's added tokens are encoded whole.

Null and empty texts are just the end id. Rows of equal doc_id are in order of text; null doc_ids
are not coded, as the files have no id for them. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerlark.llm.coder import BLOCK, decode_segment, encode_segment
from ledgerlark.llm.pieces import PieceTable, Ragged, gather, word_pieces
from ledgerlark.llm.words import text_slices
from ledgerlark.session import tune

SEGMENT_IDS = BLOCK
KEPT_PIECES = 1_000_000
SLICE_BYTES = 1 << 21
END_ID = 0

#: One word for the tokenizer: no more than a blank before letters that all its versions know.
_WORD = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+")


class Encoder:
    """Texts to ids, with the ids of the pieces met before at hand. For byte-level BPE files."""

    def __init__(self, path: str, pieces: int = KEPT_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        # A byte-level vocabulary writes one character for each byte.
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.width[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()
        self.table = PieceTable(self.add, self.clear, pieces)

    def clear(self) -> None:
        self.ids, self.start, self.size = Ragged(np.uint32), Ragged(np.int64), Ragged(np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def apart(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each text's begin, how many they are)."""
        own = self.whole(texts)
        size = np.array([len(x) for x in own], np.int64)
        return np.array([k for x in own for k in x], np.uint32), np.cumsum(size) - size, size

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of words, encoded as one text in which each ends before the next one's blank or a line break."""
        bare = np.array([t[0] != " " for t in texts])
        size = np.array([len(t.encode()) for t in texts])
        end = np.cumsum(size + bare)
        ids = np.array(self.whole(["".join([t if t[0] == " " else "\n" + t for t in texts])])[0], np.uint32)
        after = np.cumsum(self.width[ids])
        first, last = np.searchsorted(after, end - size, "right"), np.searchsorted(after, end, "right")
        if (after[last - 1] != end).any() or (bare & (after[first - 1] != end - size)).any():
            return self.apart(texts)
        return ids, first, last - first

    def add(self, texts: list[bytes]) -> None:
        plain = [t.decode() for t in texts]
        word = np.array([_WORD.fullmatch(t) is not None for t in plain])
        start, size = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for chosen, made in ((np.flatnonzero(word), self.words), (np.flatnonzero(~word), self.apart)):
            if len(chosen):
                ids, first, size[chosen] = made([plain[k] for k in chosen.tolist()])
                start[chosen] = self.ids.add(ids) + first
        self.start.add(start)
        self.size.add(size)

    def encode(self, data: np.ndarray, offsets: np.ndarray, special: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, all ids) with the end id behind each text; `special` texts are encoded whole."""
        start, end, text = word_pieces(data, offsets)
        rows = self.table.numbers(data, start, end)
        n = len(offsets) - 1
        size = self.size.values[rows]
        counts = np.bincount(text, weights=size, minlength=n).astype(np.int64) + 1
        out = np.full(int(counts.sum()), end_id, np.uint32)
        inner = np.ones(len(out), bool)
        inner[np.cumsum(counts) - 1] = False
        out[inner] = gather(self.ids.values, self.start.values[rows], size)
        if special.any():
            parts = np.split(out, np.cumsum(counts)[:-1])
            for k in np.flatnonzero(special).tolist():
                own = self.whole([data[offsets[k] : offsets[k + 1]].tobytes().decode()])[0]
                parts[k] = np.array([*own, end_id], np.uint32)
            counts, out = np.array([len(p) for p in parts], np.int64), np.concatenate(parts)
        return counts, out

    def holds_added(self, texts: pa.Array) -> np.ndarray:
        """Which texts hold the string of an added token."""
        held = np.zeros(len(texts), bool)
        for token in self.added:
            held |= pc.fill_null(pc.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        return held


@cache
def _encoder(path: str) -> Encoder:
    """One per worker process, so that later tasks find the pieces of earlier ones."""
    return Encoder(path)


def _code(path: str, end_id: int, segment_ids: int):
    def run(batches):
        encoder, number = _encoder(path), 0
        docs, counts, ids = np.zeros(0, np.int64), np.zeros(0, np.int64), [np.zeros(0, np.uint32)]

        def segment(n: int) -> pa.RecordBatch:
            """The first n documents as a row."""
            nonlocal docs, counts, ids, number
            flat, size = np.concatenate(ids), int(counts[:n].sum())
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([number], pa.int32()), pa.array([docs[0]], pa.int64()),
                    pa.array([docs[n - 1]], pa.int64()), pa.array([size], pa.int64()),
                    pa.array([encode_segment(docs[:n], counts[:n], flat[:size])], pa.binary()),
                ],
                names=["part", "segment", "first_doc", "last_doc", "n_ids", "data"],
            )
            docs, counts, ids, number = docs[n:], counts[n:], [flat[size:]], number + 1
            return row

        for batch in batches:
            special = encoder.holds_added(batch.column(1))
            for low, high, data, offsets in text_slices(batch.column(1), SLICE_BYTES):
                own, flat = encoder.encode(data, offsets, special[low:high], end_id)
                docs = np.concatenate([docs, batch.column(0).slice(low, high - low).to_numpy(zero_copy_only=False)])
                counts = np.concatenate([counts, own])
                ids.append(flat)
                while counts.sum() > segment_ids and len(counts) > 1:
                    yield segment(max(1, int(np.searchsorted(np.cumsum(counts), segment_ids, "right"))))
        if len(docs):
            yield segment(len(docs))

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode `docs` with the tokenizer file and write the coded files to the folder `path`."""
    tune(docs.sparkSession)
    plain = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = plain.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(
        _code(tokenizer, end_id, segment_ids), "part int, segment int, first_doc long, last_doc long, n_ids long, data binary"
    ).write.parquet(path)


def _decode(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            docs, counts, ids = decode_segment(batch.column(2)[row].as_py())
            start = np.concatenate([[0], np.cumsum(counts)])
            raw = ids.astype("<u4")
            sums = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)]
            n = len(docs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, batch.column(0)[row].as_py(), np.int32)), pa.array(np.full(n, batch.column(1)[row].as_py(), np.int32)),
                    pa.array(docs.copy()), pa.array(start[:-1]), pa.array(counts), pa.array(np.array(sums, np.int64)),
                ],
                names=["part", "segment", "doc_id", "inside", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before it in the whole corpus), n_tokens and ids_crc32, from the files.

    The starts need one row per segment, ordered; the segments themselves decode where they lie.
    """
    files = spark.read.schema("part int, segment int, first_doc long, last_doc long, n_ids long, data binary").parquet(path)
    order = Window.orderBy("part", "segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "segment", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    decoded = files.select("part", "segment", "data").mapInArrow(
        _decode, "part int, segment int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    return decoded.join(starts, ["part", "segment"]).select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
