"""Spelling variants against a comparison of all words, damage and prefixes included."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus as C
from ledgerlark.llm import spelling
from ledgerlark.session import Staging


def vocabulary(rows, spoiled=199, least=6, count=5):
    seen = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(C._LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % spoiled == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            seen[word] += 1
    return {w: n for w, n in seen.items() if len(w) >= least and n >= count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants(words, times=5):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= times * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def got(spark, rows, **options):
    found = spelling.spelling_variants(C.frame(spark, rows, word="x", n=1, form="y").repartition(3), Staging(spark, "t"), **options).collect()
    assert len({r.word for r in found}) == len(found)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found}


def misspelt(seed, n, alphabet="abé"):
    r = random.Random(seed)
    base = ["".join(r.choice(alphabet) for _ in range(r.randrange(5, 9))) for _ in range(40)]
    texts = []
    for _ in range(n):
        out = []
        for _ in range(r.randrange(60)):
            word = base[min(int(r.expovariate(0.15)), 39)]
            for _ in range(r.choice([0, 0, 0, 0, 1, 1, 2])):
                at = r.randrange(len(word))
                word = r.choice([word[:at] + word[at + 1 :], word[:at] + r.choice(alphabet) + word[at:], word[:at] + r.choice(alphabet) + word[at + 1 :]])
            out.append(r.choice([word, word.capitalize(), word.upper()]))
        texts.append(r.choice([" ", ", ", "Ā", "1"]).join(out))
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("leaf", [1, 7, 60, 100_000])
def test_all_leaf_sizes_find_the_same_variants(spark, leaf):
    rows = misspelt(3, 300)
    rows += [(900 + i, t) for i, t in enumerate(C.awkward_texts())] + [rows[0], (None, rows[1][1])]
    rows += [(2000 + i, "×÷Ààxyz " + "q" * 90 + " " + "q" * 91) for i in range(30)]
    rows.append((3000, "chaaain " * 200 + "chaain " * 33 + "chaxin " * 6))
    want = variants(vocabulary(rows, spoiled=7))
    assert got(spark, rows, spoiled=7, leaf_words=leaf) == want
    assert sum(v[0] is not None for v in want.values()) > 20 and any(v[0] != v[1] and v[0] for v in want.values())


def test_production_settings_on_prose(spark):
    rows = misspelt(8, 400, "abcd") + [(5000, "Straße straße STRASSE " * 9)]
    assert got(spark, rows) == variants(vocabulary(rows))


def test_one_prefix_that_holds_nearly_all_words(spark):
    r = random.Random(4)
    words = ["prefix" + "".join(r.choice("xyz") for _ in range(r.randrange(6))) for _ in range(400)] + ["abcdef", "abcdeg"]
    rows = [(i, " ".join(words)) for i in range(6)]
    assert got(spark, rows, leaf_words=20) == variants(vocabulary(rows))


def test_nothing_to_count(spark):
    assert got(spark, []) == {} and got(spark, [(1, None), (2, ""), (3, "short")] * 9) == {}


def test_joined_checksums():
    r = random.Random(1)
    pairs = [(r.randbytes(r.randrange(9)), r.randbytes(r.randrange(65))) for _ in range(500)]
    first, second, size = (np.array(x) for x in zip(*[(zlib.crc32(a), zlib.crc32(b), len(b)) for a, b in pairs], strict=True))
    joined = spelling.joined_crc(first.astype(np.uint32), second.astype(np.uint32), size)
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_the_acceptor_is_minimal_and_complete():
    words = sorted({"".join(w) + end for w in ("ab", "b", "", "abab") for end in ("tion", "ting", "tings", "")} | {"x" * 3000})
    made = spelling.Acceptor(words)
    assert sorted(made.strings(0)) == words
    assert {frozenset(p) for p in made.pairs()} == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}
    assert len(list(made.pairs())) == len({frozenset(p) for p in made.pairs()})
