"""Benchmark decontamination on canonical templates.

Words are runs of letters, digits and bytes beyond ASCII (with a point or comma between digits),
lower-cased. Three canonical forms of every text are compared: the words as they are, a typed one
in which numbers, names (capitalised words inside a sentence) and units become placeholders, and a
typed one in which the capitalised words that begin a sentence or line are placeholders too.
Every run of WIDTH words of a benchmark item is a template window (for shorter items, the item),
and documents are hash-joined with them. Matches are gathered by diagonal, the distance between
document and item position. On a diagonal with placeholders the slots must be consistent: an
item's slot value always stands for the same value in the document. An item leaks if the windows
on consistent diagonals make up at least LEAK of its windows, if the words they cover on diagonals
at most WIDTH apart make up LEAK of its words, or if on one diagonal they cover RUN words with at
most one other word between two of them; it is `exact` if the words as they are suffice, else
`reparameterised`.

Documents are read and canonicalised once, whatever the size of the benchmark. The hashes of the
items' windows become a bitmap of 2 ** BITMAP_BITS bits, built by Spark, that travels to the tasks:
at most 16 MB, and only as much as has bits set. Windows that meet it, and a share of others that grows
with the benchmark, are written and then merge-joined with the items by hash. A window shorter than
WIDTH is its whole item, so each document tells it once; all other matches are told once for each place.

Null, empty and wordless texts and items match nothing. Items of fewer than LEAST_TYPED words match
as they are only, as a whole. Typed windows need one word as it is, and on their diagonal half of
WIDTH different places that hold words as they are. Repeated rows count once, rows of one doc_id
add up, rows without doc_id or item_id are left out; an empty benchmark finds nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlark.llm.common import by_batch, grown
from ledgerlark.llm.words import ALNUM, Words, mix, split_words, text_slices, windows
from ledgerlark.session import Staging, tune

WIDTH, LEAST_TYPED, LEAK, RUN = 8, 4, 0.5, 13
BITMAP_BITS, _BUCKET_BITS = 27, 15  # Spark's bitmaps hold 2 ** 15 bits each
# Unit words.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ounce ounces pound pounds ton tons ml l liter liters litre litres "
    "gallon gallons second seconds minute minutes hour hours day days week weeks month months year years percent dollar dollars euro euros "
    "cent cents meter meters metre metres kilometer kilometers gram grams kilogram kilograms degree degrees"
).split()
_NUMBER, _NAME, _UNIT = (np.uint64(0xD1B54A32D192ED03 + 2 * i) for i in range(3))
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_POINT = np.zeros(256, bool)
_POINT[[44, 46]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[10, 33, 46, 58, 63]] = True


def _hash_of(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return np.sort(split_words(data, np.array([0, len(data)]), ALNUM, fold=True).hash)


_UNIT_HASHES = _hash_of(UNITS)


def canonical(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, list[tuple[np.ndarray, np.ndarray]]]:
    """The words of a slice of texts; of both typed forms, their hashes and which are placeholders."""
    inside = ALNUM[data]
    digit = _DIGIT[data]
    if len(data) > 2:
        between = _POINT[data[1:-1]] & digit[:-2] & digit[2:]
        # A text's first and last byte stand between no two digits of it.
        for edge in (offsets[:-1] - 1, offsets[1:] - 2):
            between[edge[(edge >= 0) & (edge < len(between))]] = False
        inside[1:-1] |= between
    words = split_words(data, offsets, ALNUM, fold=True, inside=inside)
    digits, breaks = np.zeros(len(data) + 1, np.int64), np.zeros(len(data) + 1, np.int64)
    np.cumsum(digit, out=digits[1:])
    np.cumsum(_BREAK[data], out=breaks[1:])
    number = digits[words.end] > digits[words.start]
    fresh = np.ones(len(words.start), bool)
    fresh[1:] = breaks[words.start[1:]] > breaks[words.end[:-1]]
    fresh[words.rows[:-1][words.counts > 0]] = True
    head = data[words.start]
    capital = ~number & (head >= 65) & (head <= 90)
    at = np.minimum(np.searchsorted(_UNIT_HASHES, words.hash), len(_UNIT_HASHES) - 1)
    unit = ~number & (_UNIT_HASHES[at] == words.hash)
    forms = []
    for name in (capital & ~fresh, capital):
        typed = words.hash.copy()
        typed[name], typed[unit], typed[number] = _NAME, _UNIT, _NUMBER
        forms.append((typed, number | name | unit))
    return words, forms


def template_windows(words: Words, forms: list[tuple[np.ndarray, np.ndarray]], width: int):
    """Windows of all forms: first word, hash, and which of its words are placeholders (one bit each)."""
    first, plain = windows(words, width)
    starts, hashes, masks, before = [first], [plain], [np.zeros(len(first), np.int64)], None
    for typed, slot in forms if width >= LEAST_TYPED else []:
        _, other = windows(words, width, typed)
        mask = np.zeros(len(first), np.int64)
        for k in range(width):
            mask |= slot[first + k].astype(np.int64) << k
        use = (mask > 0) & (mask < (1 << width) - 1)
        if before is not None:
            use &= mask != before
        before = mask
        starts.append(first[use])
        hashes.append(mix(other[use] ^ np.uint64(0x2545F4914F6CDD1D)))
        masks.append(mask[use])
    return np.concatenate(starts), np.concatenate(hashes), np.concatenate(masks)


def _slot_lists(words: Words, starts: np.ndarray, masks: np.ndarray, width: int) -> pa.Array:
    """Hashes of the words behind the placeholders of each typed window."""
    held = (masks[:, None] >> np.arange(width)) & 1 == 1
    values = words.hash[(starts[:, None] + np.arange(width))[held]]
    offsets = np.concatenate([[0], np.cumsum(held.sum(axis=1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).view(np.int64)))


def _rows(ids: np.ndarray, words: Words, starts, hashes, masks, width: int, id_name: str) -> pa.RecordBatch:
    row = np.searchsorted(words.rows, starts, "right") - 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[row]), pa.array((starts - words.rows[row]).astype(np.int64)), pa.array(np.ascontiguousarray(hashes).view(np.int64)),
            pa.array(masks), _slot_lists(words, starts, masks, width),
        ],
        names=[id_name, "at", "h", "mask", "slots"],
    )


def _of_items(batch: pa.RecordBatch):
    """Template windows of benchmark items, with their width and how many places the item has."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    for low, high, data, offsets in text_slices(batch.column(1)):
        words, forms = canonical(data, offsets)
        counts = words.counts
        for width in range(1, WIDTH + 1):
            starts, hashes, masks = template_windows(words, forms, width)
            row = np.searchsorted(words.rows, starts, "right") - 1
            own = np.minimum(counts, WIDTH)[row] == width
            starts, hashes, masks, row = starts[own], hashes[own], masks[own], row[own]
            part = _rows(ids[low:high], words, starts, hashes, masks, width, "item_id")
            places = pa.array((counts[row] - width + 1).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(np.full(len(starts), width, np.int32)), places], names=[*part.schema.names, "width", "places"]
            )


def _of_documents(wanted):
    """Windows of documents that meet the bitmaps of a broadcast: width -> (buckets, their bits)."""

    def run(batches):
        bits = {}
        for width, (buckets, maps) in wanted.value.items():
            own = bits[width] = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
            for bucket, held in zip(buckets, maps, strict=True):
                own[bucket << (_BUCKET_BITS - 3) :][: len(held)] = np.frombuffer(held, np.uint8)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for low, high, data, offsets in text_slices(batch.column(1)):
                words, forms = canonical(data, offsets)
                for width, held in bits.items():
                    starts, hashes, masks = template_windows(words, forms, width)
                    place = hashes >> np.uint64(64 - BITMAP_BITS)
                    hit = np.flatnonzero(held[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                    if width < WIDTH and len(hit):
                        row = np.searchsorted(words.rows, starts[hit], "right") - 1
                        order = np.lexsort((starts[hit], hashes[hit], row))
                        fresh = np.ones(len(hit), bool)
                        fresh[1:] = (row[order][1:] != row[order][:-1]) | (hashes[hit][order][1:] != hashes[hit][order][:-1])
                        hit = hit[order[fresh | (masks[hit][order] > 0)]]
                    if len(hit):
                        yield _rows(ids[low:high], words, starts[hit], hashes[hit], masks[hit], width, "doc_id")

    return run


def _bitmaps(items: DataFrame) -> dict[int, tuple[list[int], list[bytes]]]:
    """width -> (bucket, bitmap) of the items' hashes: at most WIDTH times 2 ** (BITMAP_BITS - 15) rows of 4 KB.

    A hash's bit is its upper BITMAP_BITS bits.
    """
    # Spark numbers buckets from 1 and bits of a bucket from 0 for positive values.
    place = F.shiftrightunsigned("h", 64 - BITMAP_BITS) + 1
    rows = items.select("width", place.alias("place")).groupBy("width", F.expr("bitmap_bucket_number(place)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits")
    ).toArrow()
    out: dict[int, tuple[list[int], list[bytes]]] = {}
    for width, bucket, bits in zip(*(rows.column(c).to_pylist() for c in ("width", "bucket", "bits")), strict=True):
        own = out.setdefault(width, ([], []))
        own[0].append(bucket - 1)
        own[1].append(bits.rstrip(b"\0"))
    return out


def _covered_words(told: DataFrame, name: str) -> DataFrame:
    """doc_id, item_id and whether the words under the windows (place, diagonal, width) are a leak."""
    pair = ["doc_id", "item_id"]
    told = told.select(*pair, "diagonal", "place", "width", "words").distinct()
    along = Window.partitionBy(*pair, "diagonal").orderBy("place")
    step = F.col("place") - F.lag("place").over(along)
    runs = told.withColumn("step", step).withColumn("fresh", F.coalesce((F.col("step") > F.col("width") + 1).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("fresh").over(along))
    new = F.when(F.col("fresh") == 1, F.col("width")).otherwise(F.least("step", "width"))
    runs = runs.groupBy(*pair, "diagonal", "run").agg(F.sum(new).alias("n")).groupBy(*pair).agg((F.max("n") >= RUN).alias("long"))
    across = Window.partitionBy(*pair).orderBy("diagonal")
    diagonals = told.select(*pair, "diagonal").distinct().withColumn("gap", F.col("diagonal") - F.lag("diagonal").over(across))
    diagonals = diagonals.withColumn("band", F.sum(F.coalesce((F.col("gap") > WIDTH).cast("int"), F.lit(0))).over(across)).drop("gap")
    words = told.join(diagonals, [*pair, "diagonal"]).withColumn("word", F.explode(F.sequence("place", F.col("place") + F.col("width") - 1)))
    half = words.groupBy(*pair, "band", "words").agg(F.count_distinct("word").alias("n")).groupBy(*pair).agg(
        F.max(F.col("n") >= LEAK * F.col("words")).alias("half")
    )
    return runs.join(half, pair).select(*pair, (F.col("long") | F.col("half")).alias(name))


def leaks(docs: DataFrame, benchmark: DataFrame, work: Staging) -> DataFrame:
    """doc_id, item_id, kind, coverage (share of the item's windows) and first_word of every leak."""
    spark = tune(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropna()
    items = work.table(
        items.mapInArrow(by_batch(_of_items), "item_id long, at long, h long, mask long, slots array<long>, width int, places long").distinct(),
        "items",
    )
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).dropna()
    wanted = spark.sparkContext.broadcast(_bitmaps(items))
    found = work.table(
        plain.mapInArrow(_of_documents(wanted), "doc_id long, at long, h long, mask long, slots array<long>"), "matches"
    )
    wanted.unpersist()
    held = items.select("h", "mask").distinct()
    found = work.table(found.join(grown(held), ["h", "mask"], "left_semi").distinct(), "met")
    matched = found.join(
        grown(items.select("item_id", F.col("at").alias("place"), "h", F.col("slots").alias("item_slots"), "places", "width", "mask")), ["h", "mask"]
    ).withColumns({"diagonal": F.col("at") - F.col("place"), "typed": F.col("mask") > 0})
    matched = work.table(matched, "matched")
    key = ["doc_id", "item_id", "diagonal"]
    slots = (
        matched.where("typed").select(*key, F.explode(F.arrays_zip("item_slots", "slots")).alias("p"))
        .select(*key, F.col("p.item_slots").alias("x"), F.col("p.slots").alias("y")).groupBy(*key, "x").agg(F.min("y").alias("least"), F.max("y").alias("most"))
    )
    clashes = slots.where("least <> most").select(*key).distinct().withColumn("clash", F.lit(True))
    asis = matched.select(*key, "place", "mask", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("k"), "width")
    asis = asis.where(F.expr("shiftright(mask, k) & 1") == 0).groupBy(*key).agg(
        (F.count_distinct(F.col("place") + F.col("k")) * 2 < F.least(F.max("width"), F.lit(WIDTH))).alias("thin")
    )
    told = matched.select(*key, "place", "places", "width", "typed", "at", (F.col("places") + F.col("width") - 1).alias("words")).join(clashes, key, "left").join(asis, key, "left")
    told = told.where(~F.col("typed") | (F.col("clash").isNull() & ~F.col("thin")))
    told = work.table(told, "told")
    places = told.groupBy("doc_id", "item_id", "place", "places").agg(F.max(~F.col("typed")).alias("plain"), F.min("at").alias("at"))
    shares = places.groupBy("doc_id", "item_id").agg(
        F.count(F.lit(1)).alias("covered"), F.sum(F.col("plain").cast("long")).alias("plain"),
        F.max("places").alias("places"), F.min("at").alias("first_word"),
    )
    pair = ["doc_id", "item_id"]
    shares = shares.join(_covered_words(told, "any_words"), pair).join(_covered_words(told.where("not typed"), "plain_words"), pair, "left")
    plain = (F.col("plain") >= LEAK * F.col("places")) | F.coalesce("plain_words", F.lit(False))
    return shares.where((F.col("covered") >= LEAK * F.col("places")) | F.col("any_words")).select(
        "doc_id", "item_id", F.when(plain, "exact").otherwise("reparameterised").alias("kind"),
        (F.col("covered") / F.col("places")).alias("coverage"), "first_word",
    )
