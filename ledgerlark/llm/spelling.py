"""Spelling variants: the vocabulary composed with a one-edit transducer and itself.

Words are counted over all texts; frequent words of some length are the vocabulary. The machine
"acceptor o one edit o acceptor" accepts the pairs of words that differ by exactly one inserted,
deleted or replaced code point. Its work is cut by initial states, that is by the prefix read
before the edit:

* A prefix of more than LEAF_WORDS words is an initial state of its own. The pairs that edit right
  behind it are joined by what stays when the edit is taken out: the rest of the word with one code
  point less. Such a group holds one word for each code point and one without, never more.
* All words under a prefix of at most LEAF_WORDS words are one partition. Its task builds the
  minimised acceptor of their tails and enumerates the accepted pairs from it, states and pairs of
  states being visited once each.

A pair is found once: its edit is taken behind the longest prefix the two words share. So no task
holds more than LEAF_WORDS words, whatever prefix is frequent, and no pair is lost.

Words are runs of `letters`, with only A-Z lower-cased. One run in SPOILED is damaged on purpose
(`crc32("<doc_id>:<run>")` says which and where), so that there are variants to find. Null texts
have no words; a null doc_id counts as an empty string; repeated rows count again; other columns
are ignored. Ties between forms go to the smaller word in code-point order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlark.llm.common import by_batch
from ledgerlark.llm.words import split_words, text_slices
from ledgerlark.session import Staging, tune

LEAST_CHARS, LEAST_COUNT, TIMES, SPOILED = 6, 5, 5, 199
LEAF_WORDS = 500
SLICE_BYTES = 1 << 21
PREFIX_STEP = 8
TASK_WORDS = 25_000
_SHORT = 64

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _zero_bytes(longest: int) -> np.ndarray:
    """table[n, k, b]: the CRC-32 register b << 8 k after n zero bytes, for joining two CRCs."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    table = np.zeros((longest + 1, 4, 256), np.uint32)
    table[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(longest):
        table[n + 1] = (table[n] >> 8) ^ step[table[n] & 255]
    return table


_ZEROS = _zero_bytes(_SHORT)


def joined_crc(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of A + B from the CRCs of A and B, where B has `size` bytes, at most _SHORT."""
    out = second.copy()
    for k in range(4):
        out ^= _ZEROS[size, k, (first >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of [A-Za-z] and of U+00C0 to U+00FF, which are C3 80 to C3 BF."""
    lead = data == 0xC3
    inside = _ASCII_LETTER[data] | lead
    inside[1:] |= lead[:-1]
    return inside


def _counts(least: int, spoiled: int):
    def run(batch: pa.RecordBatch):
        ids = batch.column(0).to_pylist()
        for low, high, data, offsets in text_slices(batch.column(1), SLICE_BYTES):
            words = split_words(data, offsets, _ASCII_LETTER, fold=True, inside=_letters(data))
            follows = np.zeros(len(data) + 1, np.int64)
            np.cumsum((data & 0xC0) == 0x80, out=follows[1:])
            length = words.end - words.start - (follows[words.end] - follows[words.start])
            kept = length >= least
            row = np.repeat(np.arange(high - low), words.counts)[kept]
            start, end, length = words.start[kept], words.end[kept], length[kept]
            _, first, number, count = np.unique(words.hash[kept], return_index=True, return_inverse=True, return_counts=True)
            lowered = _LOWER[data].tobytes()
            texts = [lowered[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
            prefixes = [("" if i is None else str(i)).encode() + b":" for i in ids[low:high]]
            crc = np.array([zlib.crc32(p) for p in prefixes], np.uint32)
            own = np.array([zlib.crc32(t) for t in texts], np.uint32)
            size = end - start
            h = joined_crc(crc[row], own[number], np.minimum(size, _SHORT)).astype(np.int64)
            for k in np.flatnonzero(size > _SHORT).tolist():
                h[k] = zlib.crc32(texts[number[k]], int(crc[row[k]]))
            hit = np.flatnonzero(h % spoiled == 0)
            count = count - np.bincount(number[hit], minlength=len(count))
            out, n = [], []
            for k in hit.tolist():
                word = texts[number[k]].decode()
                at = int(h[k]) % len(word)
                if len(word) > least:
                    out.append(word[:at] + word[at + 1 :])
                    n.append(1)
            whole = np.flatnonzero(count)
            out = [texts[k].decode() for k in whole.tolist()] + out
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(count[whole].tolist() + n, pa.int64())], names=["word", "n"])

    return by_batch(run)


def count_words(docs: DataFrame, least: int = LEAST_CHARS, spoiled: int = SPOILED) -> DataFrame:
    """word and n of all words of at least `least` code points, after the damage."""
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_counts(least, spoiled), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Acceptor:
    """The minimal acceptor of strings added in ascending order, by merging finished states.

    `arcs[q]` maps code points to states, `final[q]` says whether the string read so far is one.
    """

    def __init__(self, strings: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        known: dict[tuple, int] = {}
        path, last = [0], ""

        def close(depth: int) -> None:
            while len(path) - 1 > depth:
                state = path.pop()
                key = (self.final[state], *self.arcs[state].items())
                same = known.setdefault(key, state)
                if same != state:
                    self.arcs[path[-1]][last[len(path) - 1]] = same

        for string in strings:
            common = 0
            while common < min(len(string), len(last)) and string[common] == last[common]:
                common += 1
            close(common)
            for char in string[common:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][char] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            last = string
        close(0)
        self._all: dict[int, list[str]] = {}
        self._both: dict[tuple[int, int], list[str]] = {}
        self._edits: dict[int, list[tuple[str, str]]] = {}

    def _each(self, known: dict, key, parts) -> list:
        """Fills known[key] and all it rests on, without recursion: texts may be very long words."""
        work = [key]
        while work:
            now = work[-1]
            if now in known:
                work.pop()
                continue
            needs, make = parts(now)
            missing = [n for n in needs if n not in known]
            if missing:
                work += missing
            else:
                known[now] = make()
                work.pop()
        return known[key]

    def strings(self, state: int) -> list[str]:
        """All strings accepted from a state."""

        def parts(q):
            arcs = self.arcs[q]
            own = [""] if self.final[q] else []
            return arcs.values(), lambda: own + [c + s for c, r in arcs.items() for s in self._all[r]]

        return self._all[state] if state in self._all else self._each(self._all, state, parts)

    def common(self, one: int, two: int) -> list[str]:
        """The strings accepted from both states."""
        if one == two:
            return self.strings(one)

        def parts(pair):
            q, r = pair
            if q == r:
                return (), lambda: self.strings(q)
            a, b = self.arcs[q], self.arcs[r]
            small, large = (a, b) if len(a) <= len(b) else (b, a)
            both = [(c, (min(s, large[c]), max(s, large[c]))) for c, s in small.items() if c in large]
            own = [""] if self.final[q] and self.final[r] else []
            return [p for _, p in both], lambda: own + [c + s for c, p in both for s in self._both[p]]

        key = (min(one, two), max(one, two))
        return self._both[key] if key in self._both else self._each(self._both, key, parts)

    def edits(self, state: int) -> list[tuple[str, str]]:
        """Pairs of strings from a state whose one edit stands at their very beginning."""
        if state not in self._edits:
            arcs = list(self.arcs[state].items())
            out = []
            for n, (c, r) in enumerate(arcs):
                for d, s in arcs[n + 1 :]:
                    out += [(c + rest, d + rest) for rest in self.common(r, s)]
                out += [(c + rest, rest) for rest in self.common(r, state) if not rest.startswith(c)]
            self._edits[state] = out
        return self._edits[state]

    def pairs(self):
        """Every pair of accepted strings at one edit, once."""
        work = [(0, "")]
        while work:
            state, prefix = work.pop()
            for one, two in self.edits(state):
                yield prefix + one, prefix + two
            work += [(r, prefix + c) for c, r in self.arcs[state].items()]


def _compose(batches):
    """Near words within each run of rows of one leaf; rows (leaf, word, n) sorted by leaf and word."""
    leaf, words, counts = None, [], []

    def told():
        n = dict(zip(words, counts, strict=True))
        near: dict[str, list] = {}
        if len(words) > 1:
            depth = len(leaf)
            for one, two in Acceptor([w[depth:] for w in words]).pairs():
                one, two = leaf + one, leaf + two
                for word, other in ((one, two), (two, one)):
                    key = (-n[other], other)
                    if word in near:
                        near[word][0] += 1
                        near[word][1] = min(near[word][1], key)
                    else:
                        near[word] = [1, key]
        return near

    def rows(near):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(near), pa.string()), pa.array([v[0] for v in near.values()], pa.int64()),
                pa.array([-v[1][0] for v in near.values()], pa.int64()), pa.array([v[1][1] for v in near.values()], pa.string()),
            ],
            names=["word", "n_near", "near_n", "near"],
        )

    for batch in batches:
        for own, word, n in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if own != leaf:
                if near := told():
                    yield rows(near)
                leaf, words, counts = own, [], []
            words.append(word)
            counts.append(n)
    if near := told():
        yield rows(near)


def _depths(words: DataFrame, total: int, leaf_words: int, work: Staging) -> DataFrame:
    """word, n and depth: how many of its prefixes, from the empty one on, hold more than `leaf_words` words."""
    deep = words.withColumn("depth", F.lit(0 if total <= leaf_words else 1))
    low = 1
    while total > leaf_words:
        # A prefix within a full one can be full only if all shorter ones are, so fulls are counted alone.
        open_words = deep.where((F.col("depth") == low) & (F.length("word") >= low))
        ends = F.sequence(F.lit(low), F.least(F.length("word"), F.lit(low + PREFIX_STEP - 1)))
        prefixes = open_words.select("word", F.explode(ends).alias("k")).select("word", F.expr("substring(word, 1, k)").alias("prefix"))
        full = work.table(prefixes.groupBy("prefix").count().where(F.col("count") > leaf_words).select("prefix"), f"full-{low}")
        if not full.take(1):
            break
        more = prefixes.join(full, "prefix", "left_semi").groupBy("word").agg(F.count(F.lit(1)).cast("int").alias("more"))
        deep = deep.join(more, "word", "left").select("word", "n", (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        deep = work.table(deep, f"depths-{low}")
        low += PREFIX_STEP
    return deep


def _by_initial_states(deep: DataFrame) -> DataFrame:
    """Near words whose edit stands right behind a full prefix: word, n_near, near_n, near."""
    places = deep.where("depth > 0").select("word", "n", F.explode(F.expr("sequence(0, depth - 1)")).alias("p"))
    out = F.expr("concat(substring(word, 1, p), substring(word, p + 2))")
    holes = places.where("p < length(word)").select("p", out.alias("rest"), "n", "word", F.expr("substring(word, p + 1, 1)").alias("c"))
    selves = places.select("p", F.col("word").alias("rest"), "n", "word", F.lit(None).cast("string").alias("c"))
    # One hole for each code point and the word itself: a group is as small as the alphabet.
    groups = holes.unionByName(selves).groupBy("p", "rest").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "word", "c"))).alias("all")
    )
    groups = groups.where("size(`all`) > 1").select("all", F.expr("substring(rest, p + 1, 1)").alias("next"), F.explode("all").alias("x"))
    near = groups.select(
        F.col("x.word").alias("word"),
        F.expr(
            "filter(`all`, y -> y.word <> x.word and ((x.c is not null and y.c is not null) or coalesce(x.c, y.c) <> next))"
        ).alias("near"),
    ).where("size(near) > 0")
    return near.select(
        "word", F.size("near").cast("long").alias("n_near"), (-F.col("near")[0]["m"]).alias("near_n"), F.col("near")[0]["word"].alias("near")
    )


def near_words(words: DataFrame, work: Staging, leaf_words: int = LEAF_WORDS) -> DataFrame:
    """word, n, n_near, near and near_n of every (distinct) word; near is the near word of largest n.

    `words` has columns word and n and is read several times: pass a written table.
    """
    spark = tune(words.sparkSession)
    total = words.count()
    deep = _depths(words, total, leaf_words, work)
    leaves = deep.where("depth <= length(word)").select(F.expr("substring(word, 1, depth)").alias("leaf"), "word", "n")
    # A number of its own: leaves are little data and much work, so small partitions must not be put together.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_WORDS))
    leaves = leaves.repartition(parts, "leaf").sortWithinPartitions("leaf", "word")
    deeper = work.table(leaves.mapInArrow(_compose, "word string, n_near long, near_n long, near string"), "leaves")
    both = deeper.unionByName(_by_initial_states(deep))
    best = both.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    )
    return words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.m")).alias("near_n")
    )


def roots(forms: DataFrame, work: Staging) -> DataFrame:
    """word and root for all rows (word, form), following forms to the end.

    Each round doubles the way gone. A form is met several times as often as its word, so ways are
    logarithmic in the largest count and cannot close.
    """
    now, turn = work.table(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        turn += 1
        now = work.table(moved, f"roots-{turn}")
        more = now.where("moved").take(1)
        now = now.select("word", "root")
        work.drop(f"roots-{turn - 1}")
        if not more:
            return now


def spelling_variants(
    docs: DataFrame, work: Staging, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, times: int = TIMES,
    spoiled: int = SPOILED, leaf_words: int = LEAF_WORDS,
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    A word's form is its near word of largest n, if that is at least `times` the word's own.
    """
    tune(docs.sparkSession)
    words = work.table(count_words(docs, least_chars, spoiled).where(F.col("n") >= least_count), "words")
    near = near_words(words, work, leaf_words)
    formed = F.col("near_n") >= times * F.col("n")
    told = work.table(
        near.select("word", "n", "n_near", F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n")), "near"
    )
    ends = roots(told.where("form is not null"), work)
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
