"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. Every text becomes its set of distinct 5-word shingles; documents with equal sets form a class,
   and only the class's smallest doc_id goes on.
2. A signature of TREES x DEPTH minima is read in TREES orders. Each order is sorted as a whole (a
   range shuffle on signature and doc_id, so equal signatures spread over tasks too).
3. Candidates are neighbours with a common prefix of at least SHALLOW minima, and all pairs of a
   region: the shallowest prefix group of at most REGION rows. A larger group descends one minimum
   further; where still more rows agree at full depth, they are linked with the smallest doc_id.
4. Candidates whose signatures agree in too few places are left out; the texts of all others are
   gathered once. Links with a region's smallest document are confirmed first, on full shingle
   sets; other candidates are confirmed only where they would join two components.
5. Groups that are too large at full depth and then hold several components are crowded: a common
   passage makes their documents alike. All their documents are compared by an exact join on the
   rarest shingles (`_crowded_pairs`), again only across components.

Every confirmed link is exact up to 64-bit shingle hashes. A link of similarity 0.75 is missed
only if it is no candidate in all of the 24 orders, one of its ends is in no crowded group, and no
other chain of links joins its ends.

Null, empty and blank texts have an empty set and link with nothing. Repeated rows of one doc_id
are repeated in the result. Rows of one doc_id with different texts are one document in several
versions: each is compared, and what is linked with one of them is linked with all. Rows without
doc_id have no component. Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlark.llm.common import by_batch, components, grown
from ledgerlark.llm.words import SPACED, longs, mix, seeded, sequences, split_words, text_slices, windows
from ledgerlark.session import Staging, tune

SHINGLE = 5
TREES, DEPTH, SHALLOW, REGION, REACH = 24, 5, 2, 8, 2
SLOTS = TREES * DEPTH
KEYS = ["k1", "k2", "n_shingles"]
#: A pair goes on to its full sets if this share of minima agrees: five standard errors below 0.75.
LOOK = 0.55
ROWS_PER_RANGE = 200_000
#: Ratio of the least sizes of neighbouring classes of sizes in the exact join.
SIZE_STEP = 1.02

_XOR = (seeded(SLOTS, 11) >> np.uint64(32)).astype(np.uint32)
_TIMES = (seeded(SLOTS, 13) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice."""
    words = split_words(data, offsets, SPACED, fold=True)
    first, hashes = windows(words, size)
    bounds = np.searchsorted(first, words.rows)
    counts = words.counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = dict(zip(short.tolist(), sequences(words, words.rows[short], words.rows[short + 1]), strict=True)) if len(short) else {}
    none = np.zeros(0, np.uint64)
    sets = []
    for r, n in enumerate(counts.tolist()):
        if n >= size:
            sets.append(np.unique(hashes[bounds[r] : bounds[r + 1]]))
        else:
            sets.append(np.array([whole[r]], np.uint64) if n else none)
    return sets


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of every slot, one row per (non-empty) set."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), SLOTS), np.uint32)
    for slot in range(SLOTS):
        h = (flat ^ _XOR[slot]) * _TIMES[slot]
        h ^= h >> np.uint32(15)
        out[:, slot] = np.minimum.reduceat(h, starts)
    return out


def _sign(size: int):
    def run(batch: pa.RecordBatch):
        ids, marks = batch.column(0), batch.column(2)
        for low, high, data, offsets in text_slices(batch.column(1)):
            sets = shingle_sets(data, offsets, size)
            n = np.array([len(s) for s in sets], np.int64)
            keys = np.zeros((2, len(sets)), np.uint64)
            full = np.flatnonzero(n)
            signs = [None] * len(sets)
            if len(full):
                for r, row in zip(full, _signatures([sets[r] for r in full]), strict=True):
                    signs[r] = row.tobytes()
                    keys[0, r] = np.sum(mix(sets[r] + np.uint64(1)))
                    keys[1, r] = np.sum(mix(sets[r] ^ np.uint64(0x5851F42D4C957F2D)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(low, high - low), marks.slice(low, high - low), pa.array(n), longs(keys[0]), longs(keys[1]),
                    pa.array(signs, pa.binary()),
                ],
                names=["doc_id", "mark", "n_shingles", "k1", "k2", "sign"],
            )

    return by_batch(run)


def _orders(batch: pa.RecordBatch) -> pa.RecordBatch:
    """TREES rows per document: the order's number and its DEPTH minima, high byte first."""
    signs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, TREES, DEPTH)
    keys = np.empty((len(signs), TREES, 1 + 4 * DEPTH), np.uint8)
    keys[:, :, 0] = np.arange(TREES)
    keys[:, :, 1:] = signs.astype(">u4").view(np.uint8).reshape(len(signs), TREES, 4 * DEPTH)
    rows = len(signs) * TREES
    width = 1 + 4 * DEPTH
    key = pa.Array.from_buffers(pa.binary(width), rows, [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())
    ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), TREES)
    return pa.RecordBatch.from_arrays([key, pa.array(ids)], names=["key", "doc_id"])


def _runs(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run number of each row and size of its run; same[i]: row i + 1 continues the run of row i."""
    number = np.concatenate([[0], np.cumsum(~same)])
    return number, np.bincount(number)[number]


def _candidates(batches):
    """Candidate pairs of one sorted range, and its first and last rows for the seams between ranges."""
    keys, ids = [], []
    for batch in batches:
        if batch.num_rows:
            keys.append(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, 1 + 4 * DEPTH))
            ids.append(batch.column(1).to_numpy(zero_copy_only=False))
    if not keys:
        return
    keys, ids = np.concatenate(keys), np.concatenate(ids)
    n = len(ids)
    minima = np.ascontiguousarray(keys[:, 1:]).view(">u4")
    same = keys[1:, 0] == keys[:-1, 0]
    shared = np.zeros(max(n - 1, 0), np.int64)  # longest common prefix with the next row
    for d in range(DEPTH):
        same = same & (minima[1:, d] == minima[:-1, d])
        shared += same
    pairs = []

    def add(i, j, star):
        if len(i):
            a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
            pairs.append(np.stack([a, b, np.broadcast_to(np.asarray(star, np.int64), a.shape)], 1)[a != b])

    settled = np.zeros(n, bool)
    for depth in range(SHALLOW, DEPTH + 1):
        number, size = _runs(shared >= depth)
        ends = np.concatenate([np.flatnonzero(np.diff(number)), [n - 1]])
        least = np.minimum.reduceat(ids, np.concatenate([[0], ends[:-1] + 1]))[number]
        region = ~settled & (size > 1) & (size <= REGION)
        for step in range(1, REGION):
            i = np.flatnonzero(region[:-step] & (number[:-step] == number[step:])) if step < n else np.zeros(0, int)
            add(i, i + step, (ids[i] == least[i]) | (ids[i + step] == least[i]))
        settled |= size <= REGION
        if depth == DEPTH:
            i = np.flatnonzero(~settled)
            if len(i):
                a = least[i]
                pairs.append(np.stack([a, ids[i], np.ones(len(i), np.int64)], 1)[a != ids[i]])
            crowd = np.flatnonzero(~settled | (number == number[0]) | (number == number[-1]))  # a group may go on beyond the range
    reach = shared.copy()
    for step in range(1, REACH + 1):
        if step > 1:
            reach = np.minimum(reach[:-1], shared[step - 1 :])
        i = np.flatnonzero(reach >= SHALLOW)
        add(i, i + step, 0)
    names = ["a", "b", "star", "key"]
    if pairs:
        found = np.concatenate(pairs)
        found = found[np.lexsort((-found[:, 2], found[:, 1], found[:, 0]))]
        first = np.ones(len(found), bool)
        first[1:] = np.any(found[1:, :2] != found[:-1, :2], axis=1)
        found = found[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy()), pa.array(found[:, 2] == 1), pa.nulls(len(found), pa.binary())],
            names=names,
        )
    edge = np.unique(np.concatenate([np.arange(min(REACH, n)), np.arange(max(0, n - REACH), n)]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids[edge]), pa.nulls(len(edge), pa.int64()), pa.nulls(len(edge), pa.bool_()), pa.array([keys[i].tobytes() for i in edge], pa.binary())],
        names=names,
    )
    for low in range(0, len(crowd), 10_000):
        own = crowd[low : low + 10_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[own]), pa.nulls(len(own), pa.int64()), pa.array(np.ones(len(own), bool)), pa.array([keys[i].tobytes() for i in own], pa.binary())],
            names=names,
        )


def _alike(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Pairs of which LOOK of the (one-byte) minima agree."""
    x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SLOTS) for c in (2, 3))
    kept = np.mean(x == y, axis=1) >= LOOK
    return pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(kept)) for c in (0, 1, 4)], names=["a", "b", "star"])


def _confirm(size: int, percent: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = np.zeros(batch.num_rows, bool)
        sides = [[], []]
        for side, column in zip(sides, (2, 3), strict=True):
            for _, _, data, offsets in text_slices(batch.column(column)):
                side.extend(shingle_sets(data, offsets, size))
        for r, (x, y) in enumerate(zip(*sides, strict=True)):
            common = len(np.intersect1d(x, y, assume_unique=True))
            kept[r] = 100 * common >= percent * (len(x) + len(y) - common) and common > 0
        return pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(kept)) for c in (0, 1)], names=["a", "b"])

    return by_batch(run)


def _low_bytes(batch: pa.RecordBatch) -> pa.RecordBatch:
    signs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, SLOTS)
    small = signs.astype(np.uint8)
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in small], pa.binary())], names=["doc_id", "low"])


def _shingle_rows(size: int):
    def run(batch: pa.RecordBatch):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for low, high, data, offsets in text_slices(batch.column(1)):
            sets = shingle_sets(data, offsets, size)
            n = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids[low:high], n)), pa.array(np.repeat(n, n)), longs(np.concatenate(sets))], names=["doc_id", "n", "h"]
            )

    return by_batch(run)


def _crowded_pairs(texts: DataFrame, roots: DataFrame, work: Staging, percent: int, size: int) -> DataFrame:
    """All pairs (a, b) of `texts` in different components that may have the similarity `percent`.

    Sets of n and m shingles need an overlap of percent * (n + m) / (100 + percent). In an order of
    all shingles, rarest first, their first common one then leaves that many places in both sets.
    Documents meet by shingle and by the two classes of sizes, of which each bounds the places from
    the other's least size. Rows of a shingle's most frequent component do not meet each other.
    """
    rows = work.table(texts.mapInArrow(_shingle_rows(size), "doc_id long, n long, h long"), "crowd-rows")
    often = rows.groupBy("h").agg(F.count(F.lit(1)).alias("often"))
    order = Window.partitionBy("doc_id").orderBy("often", "h")
    # A shingle of one document only takes its place in the order and meets nothing.
    placed = rows.join(often, "h").withColumn("left", F.col("n") - F.row_number().over(order) + 1)
    placed = placed.where((F.col("often") > 1) & (100 * F.col("left") >= percent * F.col("n")))
    step = float(np.log(SIZE_STEP))

    def size_class(n):
        return F.floor(F.log(n.cast("double")) / step + 1e-9)

    low, high = F.ceil(percent * F.col("n") / 100.0 - 1e-6), F.floor(100.0 * F.col("n") / percent + 1e-6)
    least = F.greatest(F.floor(F.exp((F.col("other") - 1e-6) * step) - 1e-6), low)
    placed = (
        placed.withColumn("own", size_class(F.col("n")))
        .withColumn("other", F.explode(F.sequence(size_class(low), size_class(high))))
        .where((100 + percent) * F.col("left") >= percent * (F.col("n") + least))
    )
    named = placed.join(roots.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left")
    key = ["h", "k1", "k2"]
    named = work.table(
        named.select(
            "h", F.least("own", "other").alias("k1"), F.greatest("own", "other").alias("k2"), "own", "doc_id", "n", "left",
            F.coalesce("root", "doc_id").alias("root"),
        ),
        "crowd-prefixes",
    )
    shared = named.groupBy(*key, "root").agg(F.count(F.lit(1)).alias("rows")).groupBy(*key).agg(
        F.max_by("root", F.struct("rows", "root")).alias("most"), F.count(F.lit(1)).alias("roots")
    )
    live = work.table(named.join(shared.where("roots > 1").drop("roots"), key), "crowd-shared")
    x, y = live.where("root <> most").alias("x"), live.drop("most").alias("y")
    meet = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in key]
    meet += [
        F.col("x.root") != F.col("y.root"),
        (F.col("x.k1") == F.col("x.k2")) | (F.col("x.own") != F.col("y.own")),
        (F.col("y.root") == F.col("x.most")) | (F.col("x.doc_id") < F.col("y.doc_id")),
        (100 + percent) * F.least("x.left", "y.left") >= percent * (F.col("x.n") + F.col("y.n")),
    ]
    return x.join(y, meet).select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, work: Staging, percent: int = 75, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document (see the module's text).

    Documents are linked if 100 * intersection >= percent * union of their shingle sets; `percent`
    should be 75 or more, which the number of orders is made for. The result reads tables in `work`.
    """
    tune(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = work.table(
        plain.withColumn("mark", F.xxhash64("text"))
        .mapInArrow(_sign(size), "doc_id long, mark long, n_shingles long, k1 long, k2 long, sign binary"), "signed"
    )
    sets = signed.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.min(F.struct(*KEYS)).alias("least"), F.max(F.struct(*KEYS)).alias("most")
    )
    several = work.table(sets.where("least <> most").select("doc_id", F.col("least.k1").alias("_k1"), F.col("least.k2").alias("_k2")), "several")
    if several.isEmpty():
        return _linked(plain, signed, work, percent, size)
    # Versions get ids of their own, above all others, but for one that keeps the document's.
    own = F.when((F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), F.col("doc_id")).otherwise(
        F.lit(1 << 62) + F.pmod(F.xxhash64("doc_id", "k1", "k2"), F.lit(1 << 61))
    )
    versions = work.table(
        signed.where("n_shingles > 0").join(several, "doc_id").select("doc_id", "mark", own.alias("id")).distinct(), "versions"
    )

    def renamed(rows: DataFrame) -> DataFrame:
        return rows.join(versions, ["doc_id", "mark"], "left").withColumn("doc_id", F.coalesce("id", "doc_id")).drop("id")

    apart = renamed(plain.withColumn("mark", F.xxhash64("text"))).drop("mark")
    linked = work.table(_linked(apart, renamed(signed), work, percent, size), "linked")
    ids = versions.select(F.col("doc_id").alias("a"), F.col("id").alias("b")).distinct()
    edges = ids.union(linked.join(ids.select(F.col("b").alias("doc_id")), "doc_id", "left_semi").select("component_id", "doc_id"))
    roots = components(edges, work, "versions-roots")
    result = linked.join(ids.select(F.col("b").alias("doc_id"), F.col("a").alias("_of")), "doc_id", "left")
    result = result.withColumn("doc_id", F.coalesce("_of", "doc_id")).join(
        roots.select(F.col("node").alias("component_id"), "root"), "component_id", "left"
    )
    component = F.coalesce("root", "component_id")
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _linked(plain: DataFrame, signed: DataFrame, work: Staging, percent: int, size: int) -> DataFrame:
    """`near_duplicates` where all texts of a doc_id have the same set."""
    keys = KEYS
    classes = work.table(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy(*keys).agg(F.min("doc_id").alias("rep")), "classes"
    )
    reps = work.table(
        signed.where("n_shingles > 0").select("doc_id", "sign")
        .join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"]),
        "reps",
    )
    rows = reps.count() * TREES
    ordered = (
        reps.mapInArrow(by_batch(_orders), "key binary, doc_id long")
        .repartitionByRange(max(1, -(-rows // ROWS_PER_RANGE)), "key", "doc_id")
        .sortWithinPartitions("key", "doc_id")
    )
    found = work.table(ordered.mapInArrow(_candidates, "a long, b long, star boolean, key binary"), "found")
    order = Window.partitionBy(F.substring("key", 1, 1)).orderBy("key", "a")
    prefix = 1 + 4 * SHALLOW
    seams = found.where("key is not null and star is null").select("key", "a")
    steps = [
        seams.select(
            F.col("a"), F.lead("a", step).over(order).alias("b"),
            (F.substring("key", 1, prefix) == F.substring(F.lead("key", step).over(order), 1, prefix)).alias("near"),
        )
        for step in range(1, REACH + 1)
    ]
    across = steps[0]
    for more in steps[1:]:
        across = across.union(more)
    across = across.where("near and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(False).alias("star"))
    pairs = work.table(
        found.where("key is null").select("a", "b", "star").union(across).groupBy("a", "b").agg(F.max("star").alias("star")),
        "pairs",
    )
    low = work.table(reps.mapInArrow(by_batch(_low_bytes), "doc_id long, low binary"), "low")

    joined = pairs.join(low.select(F.col("doc_id").alias("a"), F.col("low").alias("x")), "a").join(
        low.select(F.col("doc_id").alias("b"), F.col("low").alias("y")), "b"
    )
    alike = work.table(
        joined.select("a", "b", "x", "y", "star").mapInArrow(by_batch(_alike), "a long, b long, star boolean"), "alike"
    )
    ids = alike.select(F.col("a").alias("doc_id")).union(alike.select("b")).distinct()
    texts = work.table(plain.join(grown(ids), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")

    def confirmed(pairs: DataFrame, name: str, texts: DataFrame = texts) -> DataFrame:
        joined = pairs.join(grown(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x"))), "a").join(
            grown(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y"))), "b"
        )
        return work.table(joined.select("a", "b", "x", "y").mapInArrow(_confirm(size, percent), "a long, b long"), name)

    links = confirmed(alike.where("star").select("a", "b"), "links-1")
    roots = components(links, work, "components-1")
    apart = (
        alike.where("not star").select("a", "b")
        .join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
        .join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
        .where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")
    )
    more = confirmed(apart, "links-2")
    joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)
    roots = components(joined, work, "components-2")
    crowds = found.where("key is not null and star").select("key", F.col("a").alias("doc_id"))
    crowds = crowds.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    several = crowds.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("key")
    crowded = work.table(crowds.join(several, "key", "left_semi").select("doc_id").distinct(), "crowded")
    if not crowded.isEmpty():
        own = work.table(plain.join(crowded, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "crowded-texts")
        pairs = work.table(_crowded_pairs(own, roots, work, percent, size), "crowded-pairs")
        more = confirmed(pairs, "links-3", own)
        joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)
        roots = components(joined, work, "components-3")
    placed = work.table(
        classes.join(roots, classes.rep == roots.node, "left")
        .select(*[F.col(k).alias(f"_{k}") for k in keys], F.coalesce("root", "rep").alias("_component")),
        "placed",
    )
    match = (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & (F.col("n_shingles") == F.col("_n_shingles"))
    result = signed.select("doc_id", *keys).join(placed, match, "left")
    component = F.coalesce("_component", "doc_id")
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )
