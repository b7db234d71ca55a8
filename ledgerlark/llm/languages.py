"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +-1. A letter trigram binds three of them: the first
rotated twice, the second once, multiplied element by element. A text is the bundle (sum) of its
trigrams, a language the bundle of all its training texts; the prediction is the language of the
largest cosine, which is also the score (negative cosines count as 0, ties go to the smaller name).

Letters are lower-cased and folded to 63 symbols (a-z apart, others by code point); every run of
other characters is one blank. Training counts trigrams of all labelled texts, so it has no
sample and its exact integer sums do not depend on the order of rows.

`evidence` says how many different trigrams speak: (sum of counts) ** 2 / sum of squared counts, so
that a word repeated a thousand times says no more than once, and a long text without blanks as
much as one with them. `unlike` uses it to tell texts in no learned language from short ones.

A text that is null or has no letter is `und` with score 0, as is every text when nothing could
be learned. Rows stay as they are, repeated ones too; other columns are ignored or kept.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlark.llm.words import SLICE_BYTES, mix

DIMENSIONS = 512
SYMBOLS = 64
GRAMS = SYMBOLS**3
UNKNOWN = "und"
LEAST_COSINE, HALF_EVIDENCE = 0.15, 10.0
_CACHED_GRAMS = 40_000


@cache
def _symbol_of() -> np.ndarray:
    """Symbol of every code point, 0 for all but letters."""
    points = np.arange(0x110000)
    letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
    symbol = np.where(letter, 27 + points % (SYMBOLS - 27), 0).astype(np.int32)
    symbol[97:123] = np.arange(1, 27)
    return symbol


@cache
def _letters() -> np.ndarray:
    bits = mix((np.arange(SYMBOLS * DIMENSIONS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)
    return (bits.astype(np.int8) * 2 - 1).reshape(SYMBOLS, DIMENSIONS)


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Bound vectors of trigrams given by number."""
    letters = _letters()
    twice, once = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    return twice[grams // SYMBOLS**2] * once[grams // SYMBOLS % SYMBOLS] * letters[grams % SYMBOLS]


def _text_slices(texts: list[str | None]):
    low, size = 0, 0
    for high, text in enumerate(texts):
        size += len(text or "")
        if size >= SLICE_BYTES:
            yield low, high + 1
            low, size = high + 1, 0
    if low < len(texts):
        yield low, len(texts)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, trigram) of every trigram with a letter, and whether each text has a letter."""
    parts = [f" {t.lower()} ".encode("utf-32-le", "surrogatepass") if t else b"" for t in texts]
    points = np.frombuffer(b"".join(parts), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(p) // 4 for p in parts])
    symbol = _symbol_of()[points]
    lettered = np.zeros(len(texts), bool)
    lettered[row[symbol > 0]] = True
    kept = np.ones(len(symbol), bool)
    kept[1:] = (symbol[1:] > 0) | (symbol[:-1] > 0) | (row[1:] != row[:-1])
    symbol, row = symbol[kept], row[kept]
    grams = symbol[:-2] * SYMBOLS**2 + symbol[1:-1] * SYMBOLS + symbol[2:]
    inside = (row[:-2] == row[2:]) & (grams > 0)
    return row[:-2][inside], grams[inside], lettered


def _count(batches):
    """(lang, trigram, n) of one partition; columns lang and text."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for low, high in _text_slices(texts):
            row, grams, _ = trigrams(texts[low:high])
            names = sorted(set(langs[low:high]))
            number = np.array([names.index(x) for x in langs[low:high]])
            counts = np.bincount(number[row] * GRAMS + grams, minlength=len(names) * GRAMS).reshape(len(names), GRAMS)
            for name, own in zip(names, counts, strict=True):
                sums[name] = sums[name] + own if name in sums else own
    for name, counts in sums.items():
        grams = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(grams), pa.string()), pa.array(grams.astype(np.int32)), pa.array(counts[grams])],
            names=["lang", "gram", "n"],
        )


def _bundle(key, table):
    """The language's vector; a group has at most one row per trigram."""
    grams, counts = table.column("gram").to_numpy(), table.column("n").to_numpy().astype(np.float64)
    vector = np.zeros(DIMENSIONS)
    for low in range(0, len(grams), 4096):
        vector += counts[low : low + 4096] @ gram_vectors(grams[low : low + 4096]).astype(np.float64)
    return pa.table({"lang": [key[0].as_py()], "vector": pa.array([vector.tolist()], pa.list_(pa.float64()))})


def learn(labelled: DataFrame) -> dict[str, list[float]]:
    """Language -> prototype, from columns lang and text; rows without either are left out.

    What reaches the driver is one vector of DIMENSIONS numbers per language.
    """
    pairs = labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).dropna()
    counts = pairs.mapInArrow(_count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("lang").applyInArrow(_bundle, "lang string, vector array<double>").collect()
    return {r["lang"]: r["vector"] for r in sorted(rows, key=lambda r: r["lang"].encode()) if any(r["vector"])}


class _Memory:
    """Vectors of the trigrams met so far, at most about _CACHED_GRAMS of them."""

    def __init__(self):
        self.place, self.vectors = np.full(GRAMS, -1, np.int32), np.zeros((0, DIMENSIONS), np.float32)

    def of(self, grams: np.ndarray) -> np.ndarray:
        new = grams[self.place[grams] < 0]
        if len(new):
            if len(self.vectors) + len(new) > _CACHED_GRAMS:
                self.place[:], self.vectors, new = -1, self.vectors[:0], grams
            self.place[new] = np.arange(len(self.vectors), len(self.vectors) + len(new))
            self.vectors = np.concatenate([self.vectors, gram_vectors(new).astype(np.float32)])
        return self.vectors[self.place[grams]]


def _classify(prototypes: dict[str, list[float]]):
    names = list(prototypes)
    space = np.array(list(prototypes.values())).reshape(len(names), DIMENSIONS)
    space = space / np.maximum(np.linalg.norm(space, axis=1, keepdims=True), 1e-300)

    def run(batches):
        memory = _Memory()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for low, high in _text_slices(texts):
                row, grams, lettered = trigrams(texts[low:high])
                known = np.flatnonzero(np.bincount(grams, minlength=GRAMS))
                at = np.zeros(GRAMS, np.int32)
                at[known] = np.arange(len(known))
                bundles = np.zeros((high - low, DIMENSIONS), np.float32)
                evidence = np.zeros(high - low)
                for first in range(0, high - low, 256):
                    lo, hi = np.searchsorted(row, [first, min(first + 256, high - low)])
                    n = min(256, high - low - first)
                    counts = np.bincount((row[lo:hi] - first) * len(known) + at[grams[lo:hi]], minlength=n * len(known))
                    if len(known):
                        table = counts.reshape(n, -1).astype(np.float64)
                        squares = np.einsum("ij,ij->i", table, table)
                        evidence[first : first + n] = table.sum(axis=1) ** 2 / np.maximum(squares, 1)
                        bundles[first : first + n] = counts.reshape(n, -1).astype(np.float32) @ memory.of(known)
                cosines = bundles @ space.T.astype(np.float32) / np.maximum(np.linalg.norm(bundles, axis=1, keepdims=True), 1e-30)
                said = lettered if names else np.zeros(high - low, bool)
                best = np.argmax(cosines, axis=1) if names else np.zeros(high - low, int)
                score = np.clip(cosines[np.arange(high - low), best], 0, 1) if names else np.zeros(high - low)
                lang = [names[b] if s else UNKNOWN for b, s in zip(best.tolist(), said.tolist(), strict=True)]
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(lang, pa.string()), pa.array(np.where(said, score, 0.0).astype(np.float64)), pa.array(evidence)],
                    names=[*part.schema.names[1:], "lang_pred", "score", "evidence"],
                )

    return run


def identify(docs: DataFrame, prototypes: dict[str, list[float]], carry: list[str], text: str = "text") -> DataFrame:
    """The columns `carry`, then lang_pred, score (0 to 1) and evidence of each document.

    A carried column of one of these names would clash and is refused.
    """
    if {"lang_pred", "score", "evidence"} & set(carry):
        raise ValueError("lang_pred, score and evidence are the operator's own columns")
    chosen = docs.select(F.col(f"`{text}`").cast("string").alias("_text"), *[F.col(f"`{c}`") for c in carry])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[1:])
    return chosen.mapInArrow(_classify(prototypes), f"{fields}, lang_pred string, score double, evidence double")


def unlike(least: float = LEAST_COSINE, half: float = HALF_EVIDENCE):
    """Whether a text's cosine is below what its evidence asks for: half of `least` at `half` trigrams.

    Chance gives a cosine of about 1 / sqrt(DIMENSIONS) however long the text is, while that of a
    text in a learned language grows with its trigrams; so the bound grows with them too.
    """
    return F.col("score") < F.lit(least) * F.col("evidence") / (F.col("evidence") + F.lit(half))


def held_out(doc_id: str = "doc_id"):
    """Every third document by the CRC-32 of its id is kept from training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
