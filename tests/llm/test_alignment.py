"""Alignment of two tokenizers against tokens that are compared one by one."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus as C
from ledgerlark.llm import alignment
from ledgerlark.session import Staging

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    *C.awkward_texts(), "trailing ", "  two  blanks\n\n \n x", "▁lower one", "a ▁", "<|endoftext|> and <s> </s> <unk> <0x41>", "don't we'll  I'M", "tab\tand\x0b  x", "漢字かな交じり文。　全角 空白",
    "naïve café — “quoted” … ½ ﬁ", " wide  space", "emoji 👩‍👩‍👧 x 🏳️‍🌈", " x", "x y", "a" * 200 + " b", "\r\n a\r\n  b", "12 345 6789", "((( ))) '' 's", "  line  sep",
]


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(x): x for x in visible} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in visible)}
    return a, byte_of, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text, tokenizers):
    """Lists of (id, bytes) of A and B, or None."""
    a, byte_of, b = tokenizers
    if not text:
        return None
    first = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(f" {text}", add_special_tokens=False).ids]
    second = []
    for i in b.encode(text):
        name = b.id_to_piece(i)
        second.append((i, bytes([int(name[3:-1], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()))
    whole = f" {text}".encode()
    return (first, second) if all(b"".join(t for _, t in x) == whole for x in (first, second)) else None


def spans(own):
    out, at = [], 0
    for i, t in own:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def brute(rows, tokenizers):
    told, held = [], Counter()
    for _, text, *_ in rows:
        both = tokens(text, tokenizers)
        if both is None:
            told.append((0, 0, "", []))
            continue
        x, y = map(spans, both)
        links = [(i, j) for i, lo, hi in x for j, low, high in y if low < hi and lo < high]
        held.update(set(links))
        cuts = sorted({hi for *_, hi in x} & {hi for *_, hi in y})
        parts, at = [], 0
        for cut in cuts:
            parts.append("|".join(",".join(str(i) for i, lo, hi in z if at <= lo and hi <= cut) for z in (x, y)))
            at = cut
        told.append((len(x), len(y), ";".join(parts), links))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for (i, *_), (n_a, n_b, groups, links) in zip(rows, told, strict=True):
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        n_groups = groups.count("|") if n_a else 0
        out.append((i, n_a, n_b, n_groups, len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), digest))
    return out, held, most


@pytest.mark.parametrize("work", [1, 2, 7, 1000])
def test_any_number_of_pieces_gives_the_same_merge(work):
    r = random.Random(work)
    for _ in range(60):
        a, b = (sorted(r.sample(range(200), r.randrange(40))) for _ in range(2))
        of_a, i, j, groups = alignment.merge_path(np.array(a, np.int64), np.array(b, np.int64), work)
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        assert of_a.tolist() == [k == 0 for _, k in merged]
        for t, (x, k) in enumerate(merged):
            assert i[t] == sum(y < x or (k and y == x) for y in a) and j[t] == sum(y < x for y in b)
            assert groups[t] == sum(y in a for y in b if y < x)


def test_documents_equal_brute_force(spark, tokenizers, monkeypatch):
    r = random.Random(7)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "".join(r.choice(TEXTS[6:]) or "" for _ in range(3))[:300]) for i in range(60)]
    rows += [(300 + i, " ".join(C.prose(i, r.randrange(60)))) for i in range(80)] + [(301, "twice"), (None, "no id"), (301, "twice")]
    docs = C.frame(spark, rows, block=1, pair="x", n_a=3).repartition(5)
    result, pairs = alignment.align_tokenizers(docs, Staging(spark, "t"), A, B)
    want, held, most = brute(rows, tokenizers)
    assert sorted(map(tuple, result.collect()), key=str) == sorted(want, key=str)
    assert {(p.a, p.b): (p.n, p.best) for p in pairs.collect()} == {p: (n, int(n == most[p[0]])) for p, n in held.items()}


def test_small_blocks_and_forgotten_pieces(tokenizers, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_PIECES", 5)
    made = alignment.Aligner(A, B)
    want, *_ = brute([(i, t) for i, t in enumerate(TEXTS)], tokenizers)
    for _ in range(2):
        for text, (_, n_a, n_b, n_groups, n_links, _, _, digest) in zip(TEXTS, want, strict=True):
            data = np.frombuffer(f" {text or ''}".encode(), np.uint8)
            numbers, digests, doc, link = made.documents(data, np.array([0, len(data)]), np.array([bool(text)]))
            assert ([int(x[0]) for x in numbers], digests) == ([n_a, n_b, n_groups, n_links], [digest])
            assert len(doc) == len(link) == n_links


def test_no_documents(spark):
    result, pairs = alignment.align_tokenizers(C.frame(spark, []), Staging(spark, "t"), A, B)
    assert result.count() == pairs.count() == 0
    result, _ = alignment.align_tokenizers(C.frame(spark, [(1, None), (2, "")]), Staging(spark, "t"), A, B)
    assert sorted(map(tuple, result.collect())) == [(1, *[0] * 6, ""), (2, *[0] * 6, "")]
