"""Long passages that repeat across documents, found by difference-cover anchors.

A window is `width` consecutive words of one document. A word goes if a window covers it whose
word sequence also starts in a document with a smaller doc_id.

1. Anchors are shorter windows, hashed only at word positions whose remainder modulo PERIOD lies
   in COVER, a perfect difference set: for any two positions there is a shift below PERIOD that
   brings both onto the cover. An anchor has `width - PERIOD + 1` words, so two equal windows
   always share an anchor at the same place within them.
2. An anchor is shared if two different texts hold it. Equal texts are told from their sequence
   hash, so exact copies share nothing by themselves: all but the smallest doc_id go whole.
3. Extension: only windows around a shared anchor are hashed in full (128 bits). For each, the
   smallest doc_id is an aggregate with map-side combine; a later document that holds it loses it.

Null and blank texts have no words and stay as they are. Rows are the documents' rows; repeated
rows of one doc_id are one document. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlark.llm.common import by_batch, grown
from ledgerlark.llm.words import SPACED, longs, mix, sequences, split_words, text_slices, windows
from ledgerlark.session import Staging, tune

WIDTH = 50
#: A perfect difference set: every remainder is a difference of two members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
_ON_COVER = np.isin(np.arange(PERIOD), COVER)
_EMPTY = hashlib.sha256(b"").hexdigest()


def _texts(batch: pa.RecordBatch, column: int):
    for low, high, data, offsets in text_slices(batch.column(column)):
        yield low, high, data, offsets, split_words(data, offsets, SPACED, fold=False)


def _second(words) -> np.ndarray:
    return mix(words.hash ^ np.uint64(0xA24BAED4963EE407))


def _text_keys(words) -> np.ndarray:
    return sequences(words, words.rows[:-1], words.rows[1:])


def _whole(batch: pa.RecordBatch):
    """Per document: words, two hashes of their sequence, digest of them all."""
    for low, high, data, offsets, words in _texts(batch, 1):
        raw = data.tobytes()
        digests = [hashlib.sha256(b" ".join(raw[offsets[r] : offsets[r + 1]].split())).hexdigest() for r in range(high - low)]
        first = _text_keys(words)
        words.hash = _second(words)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).slice(low, high - low), pa.array(words.counts.astype(np.int64)), longs(first), longs(_text_keys(words)), pa.array(digests)],
            names=["doc_id", "n_words", "c1", "c2", "digest"],
        )


def _anchored(words, width: int):
    first, hashes = windows(words, width - PERIOD + 1)
    row = np.repeat(np.arange(len(words.counts)), words.counts)[first]
    at = first - words.rows[row]
    kept = _ON_COVER[at % PERIOD] & (words.counts[row] >= width)
    return row[kept], at[kept], hashes[kept]


def _anchors(width: int, places: bool):
    def run(batch: pa.RecordBatch):
        for _, _, _, _, words in _texts(batch, 0):
            row, at, hashes = _anchored(words, width)
            text = _text_keys(words)[row]
            arrays, names = [longs(hashes), longs(text)], ["h", "c1"]
            if places:
                arrays, names = [*arrays, pa.array(at.astype(np.int32))], [*names, "at"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return by_batch(run)


def _around(width: int):
    """Full windows that hold a shared anchor, of texts (doc_id, text, anchor places)."""

    def run(batch: pa.RecordBatch):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        places = batch.column(2)
        for low, high, _, _, words in _texts(batch, 1):
            near = np.zeros(len(words.hash) + 1, np.int64)
            for r in range(low, high):
                at = places[r].values.to_numpy()
                base, end = words.rows[r - low], words.rows[r - low + 1]
                np.add.at(near, np.minimum(base + np.maximum(at - (PERIOD - 1), 0), end), 1)
                np.add.at(near, np.minimum(base + at + 1, end), -1)
            first, h1 = windows(words, width)
            kept = np.cumsum(near)[first] > 0
            _, h2 = windows(words, width, _second(words))
            first = first[kept]
            row = np.repeat(np.arange(high - low), words.counts)[first]
            yield pa.RecordBatch.from_arrays(
                [longs(h1[kept]), longs(h2[kept]), pa.array(ids[low:high][row]), pa.array((first - words.rows[row]).astype(np.int32))],
                names=["h1", "h2", "doc_id", "at"],
            )

    return by_batch(run)


def _cut(width: int):
    """Words removed, digest of the rest and the rest itself, of texts with the starts of repeated windows."""

    def run(batch: pa.RecordBatch):
        ids, texts, places = (batch.column(c) for c in range(3))
        removed, digests, kept_texts = [], [], []
        for r in range(batch.num_rows):
            words = (texts[r].as_py() or "").encode().split()
            gone = np.zeros(len(words) + 1, np.int64)
            at = places[r].values.to_numpy()
            np.add.at(gone, np.minimum(at, len(words)), 1)
            np.add.at(gone, np.minimum(at + width, len(words)), -1)
            covered = np.cumsum(gone)[:-1] > 0
            rest = b" ".join([w for w, c in zip(words, covered.tolist(), strict=True) if not c])
            removed.append(int(covered.sum()))
            digests.append(hashlib.sha256(rest).hexdigest())
            kept_texts.append(rest.decode())
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept_texts, pa.string())],
            names=["doc_id", "cut", "cut_digest", "cut_text"],
        )

    return by_batch(run)


def repeated_passages(docs: DataFrame, work: Staging, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(one row per document, the texts that lose words).

    The first has doc_id, n_words, n_removed and kept_sha256 (of the kept words joined by one
    space), the second doc_id, cut (words lost), cut_digest and cut_text of the documents that lose
    some but not all as copies of another. `width` must be at least PERIOD + 5.
    """
    spark = tune(docs.sparkSession)
    if width < PERIOD + 5:
        raise ValueError(f"width must be at least {PERIOD + 5}")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    whole = work.table(plain.mapInArrow(by_batch(_whole), "doc_id long, n_words long, c1 long, c2 long, digest string"), "whole")
    first_of_text = work.table(
        whole.where(F.col("n_words") >= width).groupBy("c1", "c2", "n_words").agg(F.min("doc_id").alias("rep")), "texts"
    )
    texts = plain.select("text")
    shared = work.table(
        texts.mapInArrow(_anchors(width, False), "h long, c1 long").groupBy("h")
        .agg(F.min("c1").alias("least"), F.max("c1").alias("most")).where("least < most").select("h"),
        "shared",
    )
    places = (
        texts.mapInArrow(_anchors(width, True), "h long, c1 long, at int").join(grown(shared), "h")
        .groupBy("c1").agg(F.collect_set("at").alias("places"))
    )
    places = work.table(
        places.join(first_of_text.select("c1", F.col("rep").alias("doc_id")), "c1").select("doc_id", "places"), "places"
    )
    joined = plain.dropna(subset=["doc_id"]).join(grown(places), "doc_id").select("doc_id", "text", "places")
    near = work.table(joined, "near")
    around = near.mapInArrow(_around(width), "h1 long, h2 long, doc_id long, at int")
    repeated = work.table(
        around.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last").select("h1", "h2", "first"),
        "repeated",
    )
    starts = work.table(
        around.join(grown(repeated), ["h1", "h2"]).where("doc_id > first").groupBy("doc_id").agg(F.collect_set("at").alias("starts")),
        "starts",
    )
    cut = work.table(
        near.select("doc_id", "text").join(grown(starts), "doc_id").select("doc_id", "text", "starts")
        .mapInArrow(_cut(width), "doc_id long, cut long, cut_digest string, cut_text string").dropDuplicates(["doc_id"]),
        "cut",
    )
    reps = first_of_text.select(F.col("rep").alias("doc_id"), F.lit(True).alias("first_of_text"))
    losses = cut.select("doc_id", "cut", "cut_digest")
    result = whole.select("doc_id", "n_words", "digest").join(reps, "doc_id", "left").join(losses, "doc_id", "left")
    copy = (F.col("n_words") >= width) & F.col("first_of_text").isNull()
    result = result.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(_EMPTY)).otherwise(F.coalesce("cut_digest", "digest")).alias("kept_sha256"),
    )
    return result, cut
