"""Licenses, languages, leaks and nearest neighbours against brute force and on awkward input."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus as C
from ledgerlark.llm import decontaminate, languages, licenses, neighbours
from ledgerlark.session import Staging


def scan(df):
    result, spans = licenses.scan_licenses(df, Staging(df.sparkSession, "t"))
    return {r.doc_id: r for r in result.collect()}, spans


def test_base_places_agree_with_the_words(spark):
    r = random.Random(1)
    notices = ["CC-BY 4.0", "gnu General  Public\nLicense", "All rights reserved.", "all Rights (reserved)", "ccby", "cc é by", "allrights reserved"]
    rows = [(i, " ".join(x for _ in range(r.randrange(6)) for x in (*C.prose(r.randrange(99), 5), r.choice(notices)))) for i in range(80)]
    rows += [(1000 + i, t) for i, t in enumerate(C.awkward_texts())] + [rows[3]]
    got, _ = scan(C.frame(spark, rows, labels="x", base="y", h=1))
    for i, text in {r[0]: r[1] for r in rows}.items():
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels) == C.base_places(text)
        assert 0 <= got[i].score <= 1 and set(filter(None, got[i].base_labels.split(","))) <= set(got[i].labels.split(","))


def test_templates_survive_a_dropped_and_an_added_word(spark):
    text = next(words for label, words in licenses.TEMPLATES if label == "bsd").split()
    changed = [*text[:6], *text[7:14], "really", *text[14:]]
    rows = [(1, "see below. " + " ".join(text).upper()), (2, " ".join(C.prose(1, 40) + changed)), (3, " ".join(text[:6])), (4, " ".join(sorted(text)))]
    got, spans = scan(C.frame(spark, rows))
    assert [got[i].labels for i in (1, 2, 3, 4)] == ["bsd", "bsd", "", ""]
    assert got[1].score == 1.0 and licenses.AGREE <= got[2].score < 1
    place = {r.doc_id: (r.first_word, r.last_word) for r in spans.collect()}
    assert place == {1: (2, 2 + len(text) - 1), 2: (40, 40 + len(changed) - 1)}


def test_bodies_survive_edits_that_move_their_diagonals(spark):
    r, rows = random.Random(4), []
    bodies = [(label, words.split()) for label, words in licenses.TEMPLATES if len(words.split()) > 60]
    assert {label for label, _ in bodies} == {"mit", "bsd", "isc", "zlib", "apache-2.0", "gpl"}
    for i, (_, words) in enumerate(bodies):
        edited = list(words)
        for step in range(6):
            at = 20 + step * (len(words) - 25) // 6
            edited[at : at + 1] = r.choice([[], ["extra", edited[at]]])
        rows.append((i, " ".join(C.prose(i, 30) + edited + C.prose(i + 50, 30))))
        rows.append((100 + i, " ".join(r.sample(words, len(words)))))
    got, spans = scan(C.frame(spark, rows))
    long = {x.doc_id: x for x in spans.collect() if x.last_word - x.first_word > 50 and x.first_word <= 31}
    for i, (label, words) in enumerate(bodies):
        assert label in got[i].labels.split(",") and got[100 + i].labels == ""
        assert long[i].label == label and licenses.AGREE <= long[i].score < 1 and abs(long[i].last_word - 29 - len(words)) <= 8


def test_repeated_runs_count_a_template_position_once(spark):
    templates = (("x", "la la la la la la la la one two three four five six seven eight nine"),)
    rows = [(1, "la " * 40), (2, "la " * 8 + "one two three four five six seven eight nine")]
    result, _ = licenses.scan_licenses(C.frame(spark, rows), Staging(spark, "t"), templates=templates)
    assert {r.doc_id: r.labels for r in result.collect()} == {1: "", 2: "x"}


def test_a_notice_repeated_many_times_is_many_spans(spark):
    rows = [(1, "\n".join(["Released under the MIT License."] * 500)), (2, None)]
    got, spans = scan(C.frame(spark, rows))
    assert (got[1].labels, got[1].n_words, got[2].n_words, got[2].labels, got[2].score) == ("mit", 2500, 0, "", 0.0)
    assert spans.count() == 500
    assert scan(C.frame(spark, []))[0] == {}


SYLLABLES = {"en": "the and ing ion ent her that was", "de": "der die und sch ein ich ung ver", "es": "que los ado ción mente para ella ñan"}


def babble(lang, seed, n):
    r, parts = random.Random(seed), SYLLABLES[lang].split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randrange(1, 4))) for _ in range(n)).capitalize() + "."


def test_held_out_languages_are_told_apart(spark):
    rows = [(i, babble(lang, i, 4 + i % 60), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("held_out", languages.held_out())
    got = languages.identify(df, languages.learn(df.where("not held_out")), ["doc_id", "lang", "held_out"]).where("held_out").collect()
    assert len(got) > 40
    assert np.mean([r.lang == r.lang_pred for r in got]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_texts_without_letters_and_nothing_learned(spark):
    texts = [*C.awkward_texts(), "12 34 !!"]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for prototypes in (languages.learn(df), languages.learn(spark.createDataFrame([("ab cd" * 9, "xx")], "text string, lang string"))):
        got = {r.doc_id: r for r in languages.identify(df, prototypes, ["doc_id"]).collect()}
        for i, text in enumerate(texts):
            known = bool(prototypes) and any(c.isalpha() for c in text or "")
            assert got[i].lang_pred == ("xx" if known else "und") and (known or got[i].score == 0)
    with pytest.raises(ValueError):
        languages.identify(df.withColumn("score", F.lit(1)), {}, ["score"])


def test_cosines_are_those_of_the_whole_bundles():
    texts = [babble("en", 1, 300), babble("de", 2, 10), ""]
    row, grams, _ = languages.trigrams(texts)
    bundles = np.zeros((3, languages.DIMENSIONS))
    np.add.at(bundles, row, languages.gram_vectors(grams).astype(float))
    memory = languages._Memory()
    assert (memory.of(np.unique(grams)) == languages.gram_vectors(np.unique(grams))).all()
    own = languages.trigrams([texts[1]])[1]
    assert (bundles[1] == languages.gram_vectors(own).astype(float).sum(axis=0)).all() and not bundles[2].any()


ITEMS = [
    (1, "If a train travels 60 miles in 2 hours, how fast does Alice think the train travels per hour on average?"),
    (2, " ".join(C.prose(50, 40))),
    (3, "Short items have five words"),
    (4, "too short"),
    (5, None),
    (6, ""),
]


def found(spark, docs, items=ITEMS):
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("at", F.lit(1))
    return {(r.doc_id, r.item_id): (r.kind, round(r.coverage, 2)) for r in decontaminate.leaks(docs, bench, Staging(spark, "t")).collect()}


def test_leaks_exact_and_reparameterised(spark):
    train = ITEMS[0][1]
    other = train.replace("60", "75").replace("2 hours", "3 hours").replace("Alice", "Bruno").replace("miles", "km")
    clash = "If a train travels 60 miles, stops, and travels 60 miles, how fast does a train go over 60 miles"
    unlike = "If a train travels 61 miles, stops, and travels 62 miles, how fast does a train go over 63 miles"
    rows = [
        (1, f"Quiz! {train} Answer below."), (2, f"Quiz! {other} Answer below."), (3, " ".join(C.prose(1, 200) + [ITEMS[1][1].upper()])),
        (4, " ".join(C.prose(1, 30) + C.prose(50, 40)[:12])), (5, "well, SHORT items: have five words."), (6, " ".join(C.prose(3, 300))), (7, unlike),
        *[(100 + i, t) for i, t in enumerate(C.awkward_texts())],
    ]
    rows.append(rows[0])
    got = found(spark, C.frame(spark, rows, item_id=3, slots=1, h="x"), [*ITEMS, (7, clash)])
    assert got == {(1, 1): ("exact", 1.0), (2, 1): ("reparameterised", 1.0), (3, 2): ("exact", 1.0), (5, 3): ("exact", 1.0)}


def test_partial_and_edited_passages(spark):
    long, short = C.prose(60, 60), C.prose(61, 16)
    items = [(1, " ".join(long)), (2, " ".join(short))]
    rows = [
        (1, " ".join(C.prose(1, 30) + long[10:43])), (2, " ".join(C.prose(2, 9) + short[:8] + ["other"] + short[9:])),
        (3, " ".join(long[:8] + ["other"] + long[9:17])), (4, " ".join(long[:12])), (5, " ".join(short[:7])),
        (6, " ".join(long[:8] + C.prose(3, 5) + long[20:28])),
    ]
    assert {k: v[0] for k, v in found(spark, C.frame(spark, rows), items).items()} == {(1, 1): "exact", (2, 2): "exact", (3, 1): "exact"}


def test_names_that_begin_sentences_and_dense_numbers(spark):
    tom = "Tom has 5 apples. Tom buys 3 more pears. Tom gives 2 plums to Ann. How many fruits does Tom have?"
    sum_ = "Compute 12 + 7 - 3 * 4 + 15 - 8 + 6 and round it to 2 places"
    lea = tom.replace("Tom", "Lea").replace("Ann", "Bob").replace("5", "9").replace("3", "4").replace("2", "6")
    rows = [
        (1, f"Quiz: {lea}"), (2, "Compute 31 + 5 - 9 * 8 + 44 - 7 + 1 and round it to 3 places"), (3, "Compute " + "1 2 3 4 5 6 7 " * 9),
        (4, lea.replace("Lea gives", "Max gives")),
    ]
    got = found(spark, C.frame(spark, rows), [(1, tom), (2, sum_)])
    assert {k: v[0] for k, v in got.items()} == {(1, 1): "reparameterised", (2, 2): "reparameterised"}


def test_no_documents_or_no_benchmark(spark):
    rows = C.frame(spark, C.corpus(1, 10))
    assert found(spark, rows, []) == {}
    assert found(spark, C.frame(spark, [])) == {}


def leak_words(text):
    """(word, number, fresh, capital, unit) of each word."""
    out, end = [], 0
    for m in re.finditer("(?:[0-9A-Za-z\u0080-\U0010FFFF]|(?<=[0-9])[.,](?=[0-9]))+", text or ""):
        number = any(c in "0123456789" for c in m.group())
        word = m.group().translate(C._LOWER)
        fresh = not out or any(c in text[end : m.start()] for c in "\n!.:?")
        out.append((word, number, fresh, not number and "A" <= m.group()[0] <= "Z", not number and word in decontaminate.UNITS))
        end = m.end()
    return out


def leak_windows(words, width):
    """(first word, window, mask, slots)."""
    out = []
    for at in range(len(words) - width + 1):
        own = words[at : at + width]
        out.append((at, tuple(w[0] for w in own), 0, ()))
        masks = []
        for inner in (True, False) if width >= 4 else ():
            kinds = ["#" if w[1] else "unit" if w[4] else "name" if w[3] and not (inner and w[2]) else None for w in own]
            mask = sum((k is not None) << i for i, k in enumerate(kinds))
            if 0 < mask < (1 << width) - 1 and mask not in masks:
                out.append((at, ("typed", *[k and ("slot", k) or w[0] for k, w in zip(kinds, own, strict=True)]), mask, tuple(w[0] for k, w in zip(kinds, own, strict=True) if k)))
            masks.append(mask)
    return out


def covered(told, words):
    runs, half = 0, False
    by = C.groups({(d, (p, w)) for d, p, w in told})
    for places in by.values():
        n, last = 0, None
        for place, width in sorted(places):
            n = width if last is None or place - last > width + 1 else n + min(place - last, width)
            last, runs = place, max(runs, n)
    bands, last = [], None
    for d in sorted(by):
        if last is None or d - last > 8:
            bands.append(set())
        bands[-1] |= {p + k for p, w in by[d] for k in range(w)}
        last = d
    half = any(2 * len(b) >= words for b in bands)
    return runs >= 13 or half


def brute_leaks(rows, items):
    out = {}
    texts = C.groups({(i, t) for i, t, *_ in rows if i is not None and t})
    for item, text in items:
        template = leak_words(text)
        if item is None or not template:
            continue
        width = min(len(template), 8)
        places = len(template) - width + 1
        index = C.groups([((w, m), (p, s)) for p, w, m, s in leak_windows(template, width)])
        for doc, versions in texts.items():
            by = {}
            for version in versions:
                seen = set()
                for at, w, m, s in leak_windows(leak_words(version), width):
                    if m == 0 and width < 8 and w in seen:
                        continue
                    seen.add(w)
                    for place, own in index.get((w, m), ()):
                        by.setdefault(at - place, []).append((place, m, own, s, at))
            told = []
            for diagonal, met in by.items():
                pairs = C.groups({(x, y) for _, _, own, s, _ in met for x, y in zip(own, s, strict=True)})
                clash = any(len(v) > 1 for v in pairs.values())
                asis = {p + k for p, m, *_ in met for k in range(width) if not m >> k & 1}
                sound = not clash and 2 * len(asis) >= min(width, 8)
                told += [(diagonal, p, m, at) for p, m, _, _, at in met if not m or sound]
            if not told:
                continue
            share, plain = len({p for _, p, *_ in told}), len({p for _, p, m, _ in told if not m})
            if 2 * share < places and not covered([(d, p, width) for d, p, *_ in told], len(template)):
                continue
            exact = 2 * plain >= places or covered([(d, p, width) for d, p, m, _ in told if not m], len(template))
            out[doc, item] = ("exact" if exact else "reparameterised", round(share / places, 2))
    return out


def test_leaks_equal_brute_force(spark):
    r = random.Random(9)
    names, units = ["Tom", "Ann", "Lea", "Max"], ["km", "hours", "Dollars"]

    def sentence():
        kinds = [lambda: r.choice(names), lambda: str(r.randrange(30)), lambda: r.choice(units), lambda: f"{r.randrange(9)}.{r.randrange(9)}"]
        return " ".join(r.choice(kinds)() if r.random() < 0.3 else f"v{r.randrange(25)}" for _ in range(r.randrange(1, 14))).capitalize() + r.choice([".", "?", "\n", ","])

    base = [" ".join(sentence() for _ in range(r.randrange(1, 5))) for _ in range(25)]
    items = [(i, t) for i, t in enumerate(base)] + [(90, "What is two"), (91, "Solve it now"), (92, "yes"), (93, "!!"), (94, None), (3, base[3])]

    def changed(text):
        out = []
        for w in text.split(" "):
            if r.random() < 0.1:
                continue
            core = w.strip(".?,\n")
            w = w.replace(core, r.choice(names)) if core in names and r.random() < 0.5 else w
            out.append(w.replace(core, str(r.randrange(30))) if core.isdigit() and r.random() < 0.7 else w)
        return " ".join(out)

    rows = [(i, " ".join([sentence(), changed(r.choice(base)), sentence()] + ([r.choice(base)] if r.random() < 0.2 else []))) for i in range(120)]
    rows += [(200, "well, what IS two?"), (201, "so solve it, now"), (202, "is two what"), (203, "Yes yes yes no"), rows[0], (0, base[1]), (None, base[2])]
    rows += [(300 + i, t) for i, t in enumerate(C.awkward_texts())]
    got, want = found(spark, C.frame(spark, rows).repartition(3), items), brute_leaks(rows, items)
    assert got == want
    assert len(want) > 60 and {k for k, _ in want.values()} == {"exact", "reparameterised"}
    assert {(200, 90), (201, 91), (203, 92)} <= set(want) and (202, 90) not in want


def test_other_hashes_on_the_same_bit_do_no_harm(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BITMAP_BITS", 15)
    rows = [(i, " ".join(C.prose(i, 300))) for i in range(30)] + [(99, ITEMS[1][1])]
    assert found(spark, C.frame(spark, rows)) == {(99, 2): ("exact", 1.0)}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("vector", F.lit(1)).withColumn("shard", F.lit("x"))


def nearest(spark, rows, **options):
    out = {}
    for r in neighbours.nearest(vectors(spark, rows), Staging(spark, "t"), **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def brute(rows, every, k):
    ids, points = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for q in ids[ids % every == 0]:
        d = np.sqrt(((points - points[ids == q][0]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def clustered(seed, n, size=12):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, size))
    return [(i, (centres[i % 5] + 0.4 * r.normal(size=size)).tolist()) for i in range(n)]


def test_factor_one_is_exact_search(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 50)
    rows = clustered(1, 700)
    rows += [(700 + i, rows[i % 3][1]) for i in range(300)]  # a large group of equal vectors
    got, want = nearest(spark, rows, every=50, factor=1.0), brute(rows, 50, 10)
    assert {q: [v for v, _ in r] for q, r in got.items()} == {q: [v for v, _ in r] for q, r in want.items()}
    assert max(abs(a[1] - b[1]) for q in want for a, b in zip(got[q], want[q], strict=True)) < 1e-12


def test_the_default_factor_keeps_the_recall(spark):
    r = np.random.default_rng(2)
    points = r.normal(size=(3000, 64))
    rows = [(i, (p / np.linalg.norm(p)).tolist()) for i, p in enumerate(points)]
    got, want = nearest(spark, rows), brute(rows, 100, 10)
    recall = np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 10 for q in want])
    assert recall >= 0.9


def test_vectors_that_take_no_part(spark):
    good = [(100 * i, [float(i), 1.0]) for i in range(4)]
    bad = [(500, None), (600, [0.0, 0.0]), (700, [1.0, None]), (800, [float("nan"), 1.0]), (900, [float("inf"), 1.0]), (1000, []), (None, [1.0, 1.0])]
    got = nearest(spark, [*good, *bad, good[1], (1100, [1.0, 1.0, 1.0])])
    assert {q: [v for v, _ in r] for q, r in got.items()} == {0: [100, 200, 300], 100: [0, 200, 300], 200: [100, 300, 0], 300: [200, 100, 0]}
    assert nearest(spark, []) == {}
    assert nearest(spark, [(1, [1.0]), (2, [1.0])]) == {}


def test_regions_out_of_reach_are_not_searched(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 40)
    r = np.random.default_rng(5)
    centres = 100.0 * np.eye(8)
    rows = [(i, (centres[i % 8] + r.normal(size=8)).tolist()) for i in range(1600)]
    table = neighbours.usable(vectors(spark, rows), "vec_id", "embedding")
    trees = neighbours._sample(table, 1600, 8)
    points = np.array([p for _, p in rows])
    home = np.full(1600, -1)
    for number, at in neighbours._reached(trees[8], points, None, np.arange(1600)):
        home[at] = number
    assert len(set(home.tolist())) >= 16 and (home >= 0).all()
    visits = sum(len(at) for _, at in neighbours._reached(trees[8], points, (np.full(1600, 5.0), 1.0), np.arange(1600)))
    assert 1600 <= visits < 1600 * len(set(home.tolist())) / 2  # centres at equal distances are the hard case
    got, want = nearest(spark, rows, every=20, factor=1.0), brute(rows, 20, 10)
    assert {q: [v for v, _ in own] for q, own in got.items()} == {q: [v for v, _ in own] for q, own in want.items()}


def test_one_id_with_two_vectors_is_the_smaller_one(spark):
    rows = [(100, [5.0, 1.0]), (1, [9.0, 9.0]), (1, [5.0, 2.0]), (2, [5.0, 4.0]), (2, [5.0, 4.0])]
    for order in (rows, rows[::-1]):
        assert nearest(spark, order) == {100: [(1, 1.0), (2, 3.0)]}


def test_lengths_outside_the_sample_have_a_region(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 4)
    monkeypatch.setattr(neighbours, "SAMPLE_ROWS", 2)
    rows = [(i, [float(i), 1.0, 1.0][: 1 + i % 3]) for i in range(1, 60)]
    got = nearest(spark, rows, every=10, k=2, factor=1.0)
    assert {q: [v for v, _ in own] for q, own in got.items()} == {q: [q - 3, q + 3] for q in (10, 20, 30, 40, 50)}
