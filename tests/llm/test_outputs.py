"""Sharding, mixing, chat formatting, token files and the pipeline."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus as C
import corpus_pipeline
from ledgerlark.llm import chat, coder, languages, mixing, pieces, sharding
from ledgerlark.llm.coder import Damaged, decode_segment, encode_segment
from ledgerlark.llm.token_files import Encoder, read_tokens, write_tokens
from ledgerlark.session import Staging

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def prefix(doc_id):
    return int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[: sharding.BITS // 4], 16)


def test_every_shard_fits_and_no_bucket_splits_without_need(spark):
    rows = C.corpus(1, 150)
    limit = 2500
    out = sharding.assign_shards(C.frame(spark, rows, shard=1, page="p", bytes=0), Staging(spark, "t"), limit).collect()
    assert sorted((r.doc_id, r.text or "") for r in out) == sorted((r[0], r[1] or "") for r in rows)
    size = defaultdict(int)
    for r in out:
        assert r.bytes == len((r.text or "").encode())
        size[r.shard, r.page] += r.bytes
    single = {(r.shard, r.page) for r in out if r.bytes > limit}
    assert all(s <= limit or key in single for key, s in size.items())
    total = defaultdict(int)
    for i, text, *_ in rows:
        for depth in range(sharding.BITS + 1):
            total[depth, prefix(i) >> (sharding.BITS - depth)] += len((text or "").encode())
    for r in out:
        want = next(d for d in range(sharding.BITS + 1) if total[d, prefix(r.doc_id) >> (sharding.BITS - d)] <= limit or d == sharding.BITS)
        assert r.depth == want


def test_one_id_that_holds_most_rows_gets_pages(spark):
    rows = [(7, "x" * 30)] * 500 + [(7, "y" * 90), (7, "z" * 400)] + [(i, "w" * 10) for i in range(40)] + [(None, "n"), (7, None)]
    out = sharding.assign_shards(C.frame(spark, rows).repartition(5), Staging(spark, "t"), 100).collect()
    assert len(out) == len(rows)
    size = defaultdict(list)
    for r in out:
        size[r.shard, r.page].append(r.bytes)
    assert all(sum(s) <= 100 or len(s) == 1 for s in size.values())
    assert sharding.assign_shards(C.frame(spark, []), Staging(spark, "t")).count() == 0


def mixed(spark, rows, **options):
    return mixing.mix(C.frame(spark, rows, size=3, key="k", target=1), Staging(spark, "t"), **options).collect()


def test_targets_and_whole_epochs(spark):
    rows = [(i, " ".join(C.prose(i, 5 + i * 7 % 90)), f"s{min(i % 17, 5)}" if i % 11 else None) for i in range(600)]
    rows += [(1000 + i, t, "odd") for i, t in enumerate(C.awkward_texts())] + [(2000, None, "empty")]
    out = mixed(spark, rows)
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    text = {r[0]: r[1] for r in rows}
    for r in out:
        assert r.size == len(C.space_words(text[r.doc_id])) and r.taken == r.size * r.copies <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = C.target_shares(sizes)
    for source in sizes:
        assert target[source] == pytest.approx(want[source])
        assert abs(taken[source] - want[source]) <= 60 or source == "odd"
    full = [s for s in sizes if want[s] == 2 * sizes[s]]
    assert full and all(r.copies == 2 or not r.size for r in out if r.source in full)
    assert sorted(map(tuple, mixed(spark, rows[::-1]))) == sorted(map(tuple, out))


def test_heavier_documents_are_taken_more_often(spark):
    rows = [(i, "a b c d", "big") for i in range(2000)] + [(5000 + i, "a b c d", "tiny") for i in range(2)]
    df = C.frame(spark, rows).withColumn("heavy", F.col("doc_id") % 2)
    out = mixing.mix(df, Staging(spark, "t"), F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(4.0)).where("source = 'big'").collect()
    light, heavy = (np.mean([r.copies for r in out if r.doc_id % 2 == odd]) for odd in (0, 1))
    assert heavy > light + 0.1


def test_one_id_on_many_rows_and_an_empty_table(spark):
    out = mixed(spark, [(1, "a b c", "x")] * 300 + [(2, "a", "x"), (3, "b c", None)])
    assert len(out) == 302 and len({r.copies for r in out if r.doc_id == 1}) == 1
    assert mixed(spark, []) == [] and all(r.taken == 0 for r in mixed(spark, [(1, None, None), (2, " ", "x")]))


HARD = [
    "", "plain", "</turn>", "<\\/turn>", "### ", "#### x", "#\\### y", "a</turn>\n### user: b", "\\", "\\\\### </turn>", "%3C%25", "<</turn>", "</turn",
    "### Assistant: </turn> ok", "\\### Assistant: </turn> ok", "ends with #", "é ### 漢</turn>字", "line\nbreak", ": ",
]


def chats(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(1)).withColumn("at", F.lit(2))
    return chat.format_chats(df)


def turns_of(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        out[c].append((t is not None, t, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2], x[3]))] for c, v in out.items()}


def check_chats(spark, rows):
    result = chats(spark, rows).cache()
    digests = {r.conv_id: r for r in chat.digests(result).collect()}
    for r in result.collect():
        turns = turns_of(rows)[r.conv_id]
        d = digests[r.conv_id]
        learned = "".join(t for role, t in turns if role == "assistant")
        assert r.identical and r.formatted.count(chat.END) == len(turns) == d.n_turns
        assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (d.loss_chars, d.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert d.formatted_chars == len(r.formatted)
        inside = "".join(r.formatted[s.start : s.start + s.length] for s in r.mask)
        assert "</turn>" not in inside and "### " not in inside
    assert set(digests) == set(turns_of(rows))


def test_hard_texts_and_roles_survive_the_round_trip(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HARD)]
    rows += [(2, i, role, "x") for i, role in enumerate(["a: b", "%", "\\", "x\n", "###", "</turn>", "", "assistant: ", "a%3A"])]
    rows += [(3, 0, None, None), (3, None, "assistant", "first"), (None, 1, "assistant", "no id"), (4, 1, "user", "same"), (4, 1, "user", "same")]
    check_chats(spark, rows)
    assert chats(spark, []).count() == 0


def test_what_the_parser_does_not_give_back_fails(spark, monkeypatch):
    rows = [(1, 0, "user", "plain"), (1, 1, "assistant", "</turn> ### ")]
    real = chat.parse
    monkeypatch.setattr(chat, "parse", lambda formatted: F.slice(real(formatted), 1, 1))
    with pytest.raises(Exception, match="does not give back conversation 1"):
        chats(spark, rows).collect()
    monkeypatch.setattr(chat, "_read", lambda piece: F.struct(F.lit("?").alias("role"), F.lit("").alias("level"), F.lit("").alias("text")))
    with pytest.raises(Exception, match="no level keeps a turn"):
        chats(spark, rows).collect()


def test_a_very_long_text(spark):
    check_chats(spark, [(1, 0, "assistant", "### </turn> word " * 20000), (1, 1, "user", "y")])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="#\\</turn> %:2C53\n", max_size=24), st.text(alphabet="a:%\\#< \n", max_size=6)), min_size=1, max_size=60))
def test_any_text_survives_the_round_trip(spark, turns):
    check_chats(spark, [(i % 5, i, role or "assistant", text) for i, (text, role) in enumerate(turns)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**28 - 1) | st.integers(0, 5), max_size=300), st.integers(1, 64))
def test_the_coder_gives_back_any_ids(ids, block):
    ids = np.array(ids, np.uint32)
    docs, counts, got = decode_segment(encode_segment(np.array([5]), np.array([len(ids)]), ids, block))
    assert (got == ids).all() and docs.tolist() == [5] and counts.tolist() == [len(ids)]


def test_ids_without_order_cost_what_their_frequency_says():
    r = np.random.default_rng(3)
    ids = (r.zipf(1.4, 60_000) % 5000).astype(np.uint32)
    share = np.bincount(ids) / len(ids)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
    data = encode_segment(np.array([1]), np.array([len(ids)]), ids)
    assert 8 * len(data) / len(ids) < 1.3 * entropy + 1
    assert (decode_segment(data)[2] == ids).all()


def test_order_0_counts_the_ids_of_all_lanes():
    r = np.random.default_rng(4)
    ids = (r.zipf(1.3, 120_000) % 3000).astype(np.uint32)
    share = np.bincount(ids) / len(ids)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
    data = encode_segment(np.array([1]), np.array([len(ids)]), ids)
    assert 8 * len(data) / len(ids) < 1.1 * entropy + 0.3
    assert (decode_segment(data)[2] == ids).all()


def test_many_lanes_and_many_different_ids(monkeypatch):
    r = np.random.default_rng(6)
    wide = np.concatenate([r.permutation(70_000), r.integers(0, 70_000, 9_000)]).astype(np.uint32)
    assert (decode_segment(encode_segment(np.array([1]), np.array([len(wide)]), wide))[2] == wide).all()
    monkeypatch.setattr(coder, "STEPS", 3)
    for n in (1, 2, 3, 4, 50, 1000):
        ids = r.integers(0, 9, n).astype(np.uint32) * 1000
        assert (decode_segment(encode_segment(np.array([1]), np.array([n]), ids, 77))[2] == ids).all()


def test_the_coder_learns_and_notices_damage():
    ids = np.tile(np.arange(40, dtype=np.uint32) * 1000, 200)
    data = encode_segment(np.array([1, 2]), np.array([3000, 5000]), ids)
    assert len(data) < len(ids)  # under a quarter of four bytes an id
    for at in (0, 9, 30, len(data) // 2, len(data) - 12):
        with pytest.raises(Damaged):
            decode_segment(data[:at] + bytes([data[at] ^ 64]) + data[at + 1 :])
    with pytest.raises(Damaged):
        decode_segment(data[:10])
    with pytest.raises(ValueError):
        encode_segment(np.array([1]), np.array([1]), np.array([2**31], np.uint32))


def library(texts):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(TOKENIZER)
    return [[*made.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def test_pieces_encode_as_whole_texts():
    import pyarrow as pa

    texts = [t or "" for t in C.awkward_texts()] + HARD + [
        "  a  b \n\n c \n", "\n", " ", "<|endoftext|> x<|endoftext|>", "a <|endoftext|> b", "<|endoftext|", "tab\tand  two", "don't we'll  I'M 'sx !'s 'S", "\x1c a\x1f b",
        "a1b2 3c ½x²y 12e ١٢ab", "é.è,ñ!É(ü)×÷ßa", "naïve—“x” 漢字 かな　x",
        " a  b c  d", "x  \t\r\n  y", "ſtraße ﬁ İ ǅ", "a·b a̧b éb", "'" * 3 + "s ''ll 're're",
    ]
    encoder = Encoder(TOKENIZER, pieces=10)
    want = library(texts)
    assert 50256 in want[texts.index("a <|endoftext|> b")]
    for _ in range(2):
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
        counts, ids = encoder.encode(data, offsets, encoder.holds_added(pa.array(texts)), 0)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_pieces_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(pieces, "mix", np.zeros_like)  # all pieces of over seven bytes meet in one slot
    r, rows = random.Random(5), []
    table = pieces.PieceTable(rows.extend, rows.clear, 400)
    for _ in range(30):
        texts = [bytes(r.choices(b"\0ab", k=r.choice([1, 2, 6, 7, 8, 9, 16, 22, 23, 24, 48, 49]))) for _ in range(100)]
        end = np.cumsum([len(t) for t in texts])
        got = table.numbers(np.frombuffer(b"".join(texts), np.uint8), end - [len(t) for t in texts], end)
        assert [rows[k] for k in got.tolist()] == texts
        kept = [t for t in rows if len(t) <= 48]
        assert len(set(kept)) == len(kept)


def test_new_words_are_encoded_in_one_call(monkeypatch):
    encoder, calls = Encoder(TOKENIZER), []
    whole = encoder.whole
    monkeypatch.setattr(encoder, "whole", lambda texts: calls.append(len(texts)) or whole(texts))
    r = random.Random(7)
    text = " ".join("".join(r.choices("abcdeéñ", k=6)) for _ in range(3000))
    counts, ids = encoder.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]), np.zeros(1, bool), 0)
    assert calls == [1] and [ids.tolist()] == library([text])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB 1'.\n\té×s—字 ½̧", max_size=30), min_size=1, max_size=5))
def test_any_text_encodes_as_whole(texts):
    encoder = Encoder(TOKENIZER)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    counts, ids = encoder.encode(data, np.cumsum([0] + [len(t.encode()) for t in texts]), np.zeros(len(texts), bool), 0)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library(texts)


def test_token_files_read_back_what_was_encoded(spark, tmp_path):
    rows = [*C.corpus(2, 80), (2000, "a <|endoftext|> b")]
    df = C.frame(spark, [*rows, (None, "no id")], start=1, n_tokens=2).repartition(6)
    write_tokens(df, f"{tmp_path}/tokens", TOKENIZER, segment_ids=700)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in read_tokens(spark, f"{tmp_path}/tokens").collect())
    at, want = 0, []
    ordered = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    for (i, *_), ids in zip(ordered, library([r[1] for r in ordered]), strict=True):
        want.append((at, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    write_tokens(C.frame(spark, []), f"{tmp_path}/none", TOKENIZER)
    assert read_tokens(spark, f"{tmp_path}/none").count() == 0


def alike(rows, text):
    """(cosine with the bundle of the one language's training texts, trigrams that speak for it)."""

    def bundle(texts):
        return languages.gram_vectors(languages.trigrams(texts)[1]).astype(float).sum(axis=0)

    a, b = bundle([text]), bundle([r[1] for r in rows if r[1] and r[2] and zlib.crc32(str(r[0]).encode()) % 3 != 1])
    counts = np.bincount(languages.trigrams([text])[1]).astype(float)
    return a @ b / np.linalg.norm(a) / np.linalg.norm(b), counts.sum() ** 2 / (counts**2).sum()


def letters(first, n, of, blank=0):
    return "".join(" " if blank and i % blank == blank - 1 else chr(first + (i * i + 7 * i) % of) for i in range(n))


def test_the_pipeline_stage_by_stage(spark, tmp_path):
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in C.corpus(3, 120)]
    leak = " ".join(C.prose(77, 30))
    rows += [(3000 + i, " ".join(C.prose(300 + i, 60)) + " " + leak, "en", "s1", 1) for i in range(3)] + [(4000, "12 34", "en", "s1", 5)]
    foreign = [letters(0x3B1, 3600, 24), letters(0x4E00, 3200, 997), letters(0x3B1, 480, 24, 7), letters(0x430, 60, 32, 6)]
    rows += [(4001 + i, t, None, "s1", 5) for i, t in enumerate(foreign)]
    plain = " ".join(C.prose(500, 90))
    rows += [(None, plain, "en", "s2", 3), (None, plain, "en", "s2", 3), (None, " ".join(C.prose(501, 40)), "en", None, 3), (None, f"{plain} {leak}", "en", "s2", 1)]
    rows += [(4100, " ".join(C.prose(502, 70)), "en", "s2", 1)] * 2
    spark.createDataFrame(rows, C.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept.append(docs)
        assert list(docs.columns[:5]) == list(corpus_pipeline.COLUMNS)
    ids = [sorted((-1 if r.doc_id is None else r.doc_id) for r in d.collect()) for d in kept]
    lettered = []
    for r in rows:
        if any(c.isalpha() for c in r[1] or ""):
            cosine, evidence = alike(rows, r[1])
            if cosine >= 0.15 * evidence / (evidence + 10):
                lettered.append(r)
    assert len(lettered) > 125 and not {4000, 4001, 4002, 4003, 4004} & {r[0] for r in lettered}
    assert ids[0] == sorted(-1 if r[0] is None else r[0] for r in lettered)
    named = [(10**9 + sum(r[1].encode()) if r[0] is None else r[0], *r[1:]) for r in lettered]
    groups = C.near_duplicates(named)
    assert ids[1] == sorted(-1 if i >= 10**9 else i for i, (_, root) in groups.items() if i == root)
    assert ids[1].count(-1) == 3 and ids[1].count(4100) == 1
    assert ids[2] == [i for i in ids[1] if i < 3000 or i == 4100][1:]  # the leak goes, also without an id
    times = {ids[3].count(i) / ids[2].count(i) for i in set(ids[2]) - {-1}}
    assert set(ids[3]) <= set(ids[2]) and times == {0, 1, 2}
    assert ids[4] == ids[3]
    work = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r.doc_id or -1, r.shard) for r in work.collect()) == sorted((r.doc_id or -1, r.shard) for r in kept[4].collect())


def test_the_pipeline_on_empty_tables_and_clashing_columns(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in ([], [(1, " ".join(C.prose(1, 50))), (1, " ".join(C.prose(2, 50))), (None, None), (2, "")]):
        docs = C.frame(spark, rows, score=1, lang_pred="x", kept=2, key="k", size=1, shard="s", _key=9)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            assert list(docs.columns[:5]) == list(corpus_pipeline.COLUMNS)
        got = [r.doc_id for r in docs.collect()]
        assert set(got) <= {1} and bool(got) == bool(rows)
