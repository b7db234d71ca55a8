"""Near-duplicates, repeated passages and connected components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus as C
from ledgerlark.llm.common import components
from ledgerlark.llm.near_dups import near_duplicates, shingle_sets
from ledgerlark.llm.substrings import COVER, PERIOD, repeated_passages
from ledgerlark.llm.words import SPACED, split_words, text_slices
from ledgerlark.session import Staging


def near(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, Staging(df.sparkSession, "t")).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_agree_with_all_pairs(spark, seed):
    rows = C.corpus(seed)
    want = {i: (n, root, i == root) for i, (n, root) in C.near_duplicates(rows).items()}
    assert near(C.frame(spark, rows, component_id=5, kept=False, sign="x")) == want


def test_a_large_group_of_near_copies_is_one_component(spark):
    r = random.Random(4)
    base = C.prose(5, 300)
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(3):
            words[r.randrange(300)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(base)) for i in range(50)]
    want = C.near_duplicates(rows)
    assert near(C.frame(spark, rows).repartition(8)) == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_pairs_in_a_crowd_with_one_long_passage(spark):
    passage = [f"b{i}" for i in range(144)]
    tails = [[f"t{i}.{k}" for k in range(30)] for i in range(500)]  # 140 common shingles and 30 own ones: similarity 0.70
    for i in range(10, 60):
        tails[430 + i][:7] = tails[i][:7]  # 147 of 193: similarity 0.76
    rows = [(i, " ".join(passage + tail)) for i, tail in enumerate(tails)]
    want = {i: (n, c, i == c) for i, (n, c) in C.near_duplicates(rows).items()}
    assert sum(not kept for _, _, kept in want.values()) == 50
    assert near(C.frame(spark, rows).repartition(8)) == want


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (3, "")]
    got = near_duplicates(C.frame(spark, rows), Staging(spark, "t")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, 3, 1, True), (1, 3, 1, True), (2, 0, 2, True), (3, 0, 3, True)]
    assert near(C.frame(spark, [])) == {}


def test_an_id_with_several_texts_links_them_all(spark):
    a, b, c = (C.prose(i, 120) for i in (21, 22, 23))
    almost = [" ".join([*x[:-1], "other"]) for x in (a, b, c)]
    rows = [(5, " ".join(a)), (5, " ".join(b)), (2, almost[1]), (3, almost[0]), (4, almost[2]), (9, " ".join(c)), (5, " ".join(a)), (5, None), (7, "alone here")]
    for parts in (1, 4):
        got = near_duplicates(C.frame(spark, rows).repartition(parts), Staging(spark, "t")).collect()
        assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [
            (2, 2, True), (3, 2, False), (4, 4, True), *[(5, 2, False)] * 4, (7, 7, True), (9, 4, False)]


def test_components_of_long_chains(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 400)] + [(500, 500 + i) for i in range(1, 200)] + [(900, 901), (901, 900)]
    r.shuffle(edges)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long"), Staging(spark, "t"), "c").collect()}
    want = {i: 0 for i in range(1, 401)} | {500 + i: 500 for i in range(1, 200)} | {901: 900}
    assert got == want


def test_words_of_slices_are_those_of_the_pattern():
    import pyarrow as pa

    texts = C.awkward_texts() + [r[1] for r in C.corpus(3)]
    found = []
    for _, _, data, offsets in text_slices(pa.array(texts), limit=300):
        words = split_words(data, offsets, SPACED, fold=False)
        raw = data.tobytes()
        for a, b in zip(words.rows[:-1], words.rows[1:], strict=True):
            found.append([raw[s:e].decode() for s, e in zip(words.start[a:b], words.end[a:b], strict=True)])
    assert found == [C.space_words(t) for t in texts]


def test_equal_words_hash_alike_wherever_they_stand():
    text = "the cat THE dog the".encode()
    sets = shingle_sets(np.frombuffer(text + text.lower(), np.uint8), np.array([0, len(text), 2 * len(text)]), 3)
    assert (sets[0] == sets[1]).all() and len(sets[0]) == 3


def test_the_cover_is_a_perfect_difference_set():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeated_passages_agree_with_every_window(spark, seed):
    rows = C.corpus(seed)
    result, cut = repeated_passages(C.frame(spark, rows, starts=1, places=2), Staging(spark, "t"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in result.collect()}
    assert got == C.passages(rows)
    assert result.count() == len(rows)
    assert any(0 < removed < n for n, removed, _ in got.values())
    assert cut.where("cut = 0").isEmpty()


def test_a_passage_at_every_alignment(spark):
    passage = C.prose(7, 50)
    rows = [(i, " ".join(C.prose(100 + i, i) + passage + C.prose(200 + i, 3))) for i in range(64)]
    result, _ = repeated_passages(C.frame(spark, rows), Staging(spark, "t"))
    got = {r.doc_id: r.n_removed for r in result.collect()}
    assert got == {i: removed for i, (_, removed, _) in C.passages(rows).items()}
    assert got[0] == 0 and min(got[i] for i in range(1, 64)) >= 50


def test_passages_of_an_empty_table(spark):
    result, cut = repeated_passages(C.frame(spark, []), Staging(spark, "t"))
    assert result.count() == 0 == cut.count()
    with pytest.raises(ValueError):
        repeated_passages(C.frame(spark, []), Staging(spark, "t"), width=30)


def test_staged_tables_lie_in_the_given_folder(spark):
    work = Staging(spark, "t")
    near_duplicates(C.frame(spark, [(1, "a b c d e f"), (2, "a b c d e f")]), work).select(F.count("*")).collect()
    assert "/ledgerlark/t-" in work.root
    work.close()
