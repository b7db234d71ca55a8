"""Small made-up corpora and plain-Python versions of what the operators must find."""

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
])
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows, **extra):
    """Documents of (doc_id, text) or (doc_id, text, source); `extra` adds constant columns."""
    from pyspark.sql import functions as F

    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.withColumns({k: F.lit(v) for k, v in extra.items()}) if extra else df


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def awkward_texts():
    return [None, "", "   \n\t", "one", "Two words", "a b c d", "\x00 nul", "ünï cödé ẞ ſ İ", "!!! ???", "x" * 5000, "word " * 3000, "\x85 　 odd space"]


def corpus(seed=1, n=60):
    """(doc_id, text, source): random prose, exact and near copies, shared passages and awkward texts."""
    r = random.Random(seed)
    rows, passage = [], prose(999, 70)
    for i in range(n):
        kind = i % 6
        if kind == 1 and rows:
            text = r.choice(rows)[1]
        elif kind == 2 and rows:
            words = (r.choice(rows)[1] or "").split(" ")
            for _ in range(max(1, len(words) // 60)):
                words[r.randrange(len(words))] = f"n{r.randrange(9)}"
            text = " ".join(words)
        elif kind == 3:
            words = prose(seed * 1000 + i, r.randrange(20, 150))
            at = r.randrange(len(words))
            text = " ".join(words[:at] + passage[r.randrange(10) :] + words[at:])
        else:
            text = " ".join(prose(seed * 1000 + i, r.randrange(1, 200)))
        rows.append((i * 3 + 1, text, f"s{i % 4}" if i % 7 else None))
    rows += [(1000 + i, t, "odd") for i, t in enumerate(awkward_texts())]
    return rows + [rows[5], rows[5]]


def space_words(text, fold=False):
    text = (text or "").translate(_LOWER) if fold else (text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, size=5):
    words = space_words(text, fold=True)
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_duplicates(rows):
    """doc_id -> (n_shingles, component_id)."""
    sets = {r[0]: shingles(r[1]) for r in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def passages(rows, width=50):
    """doc_id -> (n_words, n_removed, kept_sha256)."""
    texts = {r[0]: space_words(r[1]) for r in rows}
    first = {}
    for i in sorted(texts):
        for k in range(len(texts[i]) - width + 1):
            first.setdefault(tuple(texts[i][k : k + width]), i)
    out = {}
    for i, words in texts.items():
        gone = set()
        for k in range(len(words) - width + 1):
            if first[tuple(words[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def licence_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def base_places(text):
    words, places, labels = licence_words(text), [], set()
    for phrase, label in PHRASES.items():
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def target_shares(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """source -> target, by handing out the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, target, full = share * sum(sizes.values()), {}, set()
    while True:
        rest = budget - sum(most * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        total = sum(weight[s] for s in free)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / total for s in order}
        over = [s for s in free if target[s] > most * sizes[s]]
        if not over:
            return target
        full.update(over)


def groups(values):
    out = defaultdict(list)
    for key, value in values:
        out[key].append(value)
    return out
