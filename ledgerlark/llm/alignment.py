"""Cross-tokenizer alignment: two tokenizers' tokens of the same bytes, linked and grouped.

A is a byte-level BPE (`tokenizers`), B a BPE with byte fallback (`sentencepiece`). The byte ends
of their tokens are merged. Merge-path partitioning cuts that merging: where the k-th diagonal of
the A x B grid crosses the path of the merge is found by a binary search, all diagonals at once, and
between two diagonals lie equally many ends, whatever the texts are. These pieces are merged
independently of each other, side by side as numpy lanes; each emits its overlaps, and the groups
that run over a border are stitched by adding up the groups that each piece closes.

Tokens of neither kind reach over the border before a blank behind a character that is no space
(`pieces.blank_pieces`), so each task tokenizes and merges each distinct run between such borders
once. It does so for blocks of about SLICE_BYTES of text. A block tells each of its id pairs once,
with the number of its documents that hold it; the corpus-wide counts come back to the block by one
join and are summed up there document by document. A block's size is bounded by that of its texts,
so no id pair, however frequent, holds many rows of one task.

Null and empty texts, and texts whose tokens do not give back their bytes, have no tokens. Repeated
rows are documents of their own and are counted as such; rows of a null doc_id too. Special tokens'
strings are ordinary text. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerlark.llm.pieces import PieceTable, Ragged, blank_pieces, gather
from ledgerlark.llm.words import text_slices
from ledgerlark.session import Staging, tune

SLICE_BYTES = 1 << 21
LANE_ENDS = 128
KEPT_PIECES = 500_000
_BLANK = "▁"


def merge_path(a: np.ndarray, b: np.ndarray, work: int = LANE_ENDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The merge of ascending ends a and b, A first on ties: (of_a, i, j, groups).

    Element t of the merge is an end of a if of_a[t], and i[t], j[t] are the tokens of A and B in
    which the path stands when it takes it. groups[t] is how many common ends lie before it.
    """
    total = len(a) + len(b)
    diagonal = np.arange(0, total + work, work)
    diagonal[-1] = total
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        middle = (low[open_] + high[open_]) // 2
        first = a[middle] <= b[diagonal[open_] - 1 - middle]
        low[open_[first]] = middle[first] + 1
        high[open_[~first]] = middle[~first]
    i, j = low[:-1].copy(), (diagonal - low)[:-1].copy()
    lanes = len(i)
    far = np.iinfo(np.int64).max
    ends_a, ends_b = np.append(a, far), np.append(b, far)
    of_a, at_i, at_j = np.zeros((work, lanes), bool), np.zeros((work, lanes), np.int64), np.zeros((work, lanes), np.int64)
    for step in range(work):
        take = ends_a[i] <= ends_b[j]
        of_a[step], at_i[step], at_j[step] = take, i, j
        i = np.minimum(i + take, len(a))
        j = np.minimum(j + ~take, len(b))
    of_a, at_i, at_j = (x.T.reshape(-1)[:total] for x in (of_a, at_i, at_j))
    closes = np.zeros(total, bool)
    closes[1:] = of_a[:-1] & ~of_a[1:]
    closes &= ~of_a
    taken = np.flatnonzero(closes)
    closes[taken] = a[at_i[taken] - 1] == b[at_j[taken]]
    # Stitching: what the pieces before closed, and what the own piece closed so far.
    own = np.zeros((lanes, work), np.int64)
    own.reshape(-1)[:total] = closes
    inside = np.cumsum(own, axis=1)
    before = np.cumsum(inside[:, -1]) - inside[:, -1]
    groups = (before[:, None] + inside - own).reshape(-1)[:total]
    return of_a, at_i, at_j, groups


class Aligner:
    """Tokens, groups and links of every distinct piece met; one per worker process."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.blank = self.b.piece_to_id(_BLANK)
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(name[3:-1], 16)]) if self.b.is_byte(k) else name.replace(_BLANK, " ").encode() for k, name in enumerate(names)
        ]
        self.b_size = np.array([len(x) for x in self.b_bytes])
        # A token of A is written with one character for each byte.
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_size = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, k in vocabulary.items():
            self.a_size[k] = len(token)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in visible]
        byte_of = {chr(x): x for x in visible} | {chr(256 + n): x for n, x in enumerate(hidden)}
        self.a_bytes = [b""] * len(self.a_size)
        for token, k in vocabulary.items():
            self.a_bytes[k] = bytes(byte_of[c] for c in token)
        self.clear()
        self.table = PieceTable(self.add, self.clear, KEPT_PIECES)

    def clear(self) -> None:
        self.numbers = Ragged(np.int64), Ragged(np.int64), Ragged(np.int64), Ragged(np.int64)  # n_a, n_b, n_groups, n_links
        self.sound, self.start, self.links = Ragged(bool), Ragged(np.int64), Ragged(np.int64)
        self.groups: list[str] = []

    def add(self, texts: list[bytes]) -> None:
        plain = [t.decode() for t in texts]
        a = [e.ids for e in self.a.encode_batch_fast(plain, add_special_tokens=False)]
        b = self.b.encode([t[1:] for t in plain], num_threads=1)
        b = [[self.blank] if t == " " else own for t, own in zip(plain, b, strict=True)]
        whole_a, whole_b = self.a_bytes, self.b_bytes
        sound = np.array([
            b"".join([whole_a[k] for k in x]) == t and b"".join([whole_b[k] for k in y]) == t for t, x, y in zip(texts, a, b, strict=True)
        ], bool)
        a = [x if s else [] for x, s in zip(a, sound.tolist(), strict=True)]
        b = [x if s else [] for x, s in zip(b, sound.tolist(), strict=True)]
        n_a, n_b = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
        ids_a, ids_b = (np.array([k for own in x for k in own], np.int64) for x in (a, b))
        of_a, i, j, groups = merge_path(np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b]))
        # The end of B that closes a group overlaps no other token; every other element is one link.
        closes = np.append(groups[1:], groups[-1:] + 1) > groups
        linked = np.flatnonzero(~closes)
        piece = np.repeat(np.arange(len(texts)), n_a)[i[linked]]
        n_links = np.bincount(piece, minlength=len(texts))
        last = np.flatnonzero(closes)
        end_a, end_b = i[last], j[last] + 1
        n_groups = np.bincount(np.repeat(np.arange(len(texts)), n_b)[j[last]], minlength=len(texts))
        names_a, names_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        told, low_a, low_b = [], 0, 0
        for high_a, high_b in zip(end_a.tolist(), end_b.tolist(), strict=True):
            told.append(f"{','.join(names_a[low_a:high_a])}|{','.join(names_b[low_b:high_b])}")
            low_a, low_b = high_a, high_b
        at = 0
        for n in n_groups.tolist():
            self.groups.append(";".join(told[at : at + n]))
            at += n
        for column, own in zip(self.numbers, (n_a, n_b, n_groups, n_links), strict=True):
            column.add(own)
        self.sound.add(sound)
        first = self.links.add(ids_a[i[linked]] << 32 | ids_b[j[linked]])
        self.start.add(first + np.cumsum(n_links) - n_links)

    def documents(self, data: np.ndarray, offsets: np.ndarray, here: np.ndarray):
        """Per text: n_a, n_b, n_groups, n_links and the groups' digest; and (text, link) of all links.

        `here` says which texts count; the others, and unsound ones, have no tokens.
        """
        start, end, text = blank_pieces(data, offsets)
        rows = self.table.numbers(data, start, end)
        n = len(offsets) - 1
        good = here & ~np.isin(np.arange(n), text[~self.sound.values[rows]])
        kept = good[text]
        rows, text = rows[kept], text[kept]
        numbers = [np.bincount(text, weights=column.values[rows], minlength=n).astype(np.int64) for column in self.numbers]
        bounds = np.searchsorted(text, np.arange(n + 1)).tolist()
        names, groups = rows.tolist(), self.groups
        digests = [
            hashlib.sha256(";".join([groups[k] for k in names[lo:hi]]).encode()).hexdigest() if lo < hi else ""
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)
        ]
        size = self.numbers[3].values[rows]
        return numbers, digests, np.repeat(text, size), gather(self.links.values, self.start.values[rows], size)


@cache
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


_DOCUMENT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs long, places binary, times binary"
_PAIR = "pair long, place int, docs long"


def _small(values: np.ndarray) -> np.ndarray:
    """In the smallest unsigned type that holds them."""
    top = int(values.max(initial=0))
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(data) // n] if n else np.uint8).astype(np.int64)


def _align(path_a: str, path_b: str):
    """Rows of documents, and one row for each id pair of a block of documents."""

    def run(batches):
        aligner, block = _aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            here = pc.fill_null(pc.not_equal(texts, ""), False).to_numpy(zero_copy_only=False)
            spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), pc.fill_null(texts, ""), pa.scalar("", pa.large_string()))
            for low, high, data, offsets in text_slices(spaced, SLICE_BYTES):
                numbers, digests, doc, link = aligner.documents(data, offsets, here[low:high])
                order = np.lexsort((link, doc))
                doc, link = doc[order], link[order]
                fresh = np.ones(len(doc), bool)
                fresh[1:] = (doc[1:] != doc[:-1]) | (link[1:] != link[:-1])
                at = np.flatnonzero(fresh)
                times = np.diff(np.append(at, len(doc)))
                pairs, place, docs = np.unique(link[at], return_inverse=True, return_counts=True)
                bounds = np.searchsorted(doc[at], np.arange(high - low + 1))
                sizes = np.diff(bounds)
                spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                n = high - low
                none = pa.nulls(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, block)), batch.column(0).slice(low, n), *[pa.array(x) for x in numbers], pa.array(digests, pa.string()),
                        pa.array(sizes.astype(np.int64)), pa.array([_small(np.diff(place[a:b], prepend=0)).tobytes() for a, b in spans], pa.binary()),
                        pa.array([_small(times[a:b]).tobytes() for a, b in spans], pa.binary()),
                        none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.int64()),
                    ],
                    names=_NAMES,
                )
                m = len(pairs)
                for first in range(0, m, 10_000):
                    own = slice(first, min(first + 10_000, m))
                    k = own.stop - first
                    empty = pa.nulls(k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(k, block)), empty.cast(batch.column(0).type), *[empty.cast(pa.int64())] * 4, empty.cast(pa.string()),
                            empty.cast(pa.int64()), empty.cast(pa.binary()), empty.cast(pa.binary()),
                            pa.array(pairs[own]), pa.array(np.arange(first, own.stop, dtype=np.int32)), pa.array(docs[own].astype(np.int64)),
                        ],
                        names=_NAMES,
                    )
                block += 1

    return run


_NAMES = ["block", "doc_id", *(x.split()[0] for x in f"{_DOCUMENT}, {_PAIR}".split(", "))]


def _sums(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """The sums over the links of a block's documents, from the counts of the block's pairs."""
    places = answers.column("place").to_numpy()
    counts, best = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    counts[places], best[places] = answers.column("n").to_numpy(), answers.column("best").to_numpy()
    n_best, count_sum = [], []
    for n, gaps, times in zip(*(docs.column(c).to_pylist() for c in ("n_pairs", "places", "times")), strict=True):
        own, often = np.cumsum(_wide(gaps, n)), _wide(times, n)
        n_best.append(int(best[own] @ often))
        count_sum.append(int(counts[own] @ often))
    kept = [docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    return pa.table(
        [*kept, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), docs.column("groups_sha256")],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    )


def align_tokenizers(docs: DataFrame, work: Staging, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """(one row per document, one row per linked id pair of the corpus).

    The first has doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256; the
    second a, b, n (documents that hold the pair linked) and best (1 if no pair of a has more).
    """
    tune(docs.sparkSession)
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    told = work.table(plain.mapInArrow(_align(path_a, path_b), f"block long, doc_id {kind}, {_DOCUMENT}, {_PAIR}"), "told")
    held = told.where("pair is not null").select(F.col("block").alias("home"), "pair", "place", "docs")
    counts = work.table(
        held.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("pair", 32)), "counts"
    )
    # One row for each id of A at most: bounded by the vocabulary, whatever the corpus.
    tops = counts.groupBy("a").agg(F.max("n").alias("most"))
    pairs = counts.join(F.broadcast(tops), "a").select("pair", "a", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    answers = held.join(pairs, "pair").select("home", "place", "n", "best")
    documents = told.where("pair is null").select("block", "doc_id", *_NAMES[2:10])
    result = documents.groupBy("block").cogroup(answers.groupBy("home")).applyInArrow(
        _sums, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
    return result, pairs.select("a", F.expr("pair & 4294967295").alias("b"), "n", "best")
