"""Aligned tokens against a plain pass over both tokenizers' output."""

import hashlib
import itertools
import json
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from edges import SCHEMA, odd_rows, odd_table
from retention.llm import alignment as al

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def sides():
    return al.Sides(*al._read(A, B))


def tokens(libraries, text):
    """[(id, start, end)] of both sides, by the libraries' own way back from ids to bytes."""
    if not text:
        return [], []
    a, b = libraries
    out = []
    alphabet = al.byte_alphabet()
    first = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    second = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        second.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    for side in (first, second):
        if b"".join(t for _, t in side) != (" " + text).encode():
            return [], []
        ends = list(itertools.accumulate(len(t) for _, t in side))
        out.append([(i, e - len(t), e) for (i, t), e in zip(side, ends)])
    return tuple(out)


def plain(libraries, texts):
    """All columns of the query, one token pair after another."""
    sides = [tokens(libraries, t) for t in texts]
    links = [[(i, j) for j, _, f in b for i, _, e in by_end.get(f, ())] for a, b in sides for by_end in [_by_end(a)]]
    count = Counter(pair for found in links for pair in found)
    highest = {}
    for (_, j), n in count.items():
        highest[j] = max(n, highest.get(j, 0))
    rows = []
    for (a, b), found in zip(sides, links):
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, _, e in side if low < e <= cut) for side in (a, b)))
            low = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(count[p] == highest[p[1]] for p in found)
        rows.append((len(a), len(b), len(cuts), len(found), best, sum(count[p] for p in found), digest))
    return rows


def _by_end(side):
    found = {}
    for token in side:
        found.setdefault(token[2], []).append(token)
    return found


def odd_texts():
    rnd = random.Random(5)
    alphabet = "  \n\tabcthe'é日▁½ﬁ\x00\u200b😀.,<s>|endoftext"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    return [*texts, "a▁b", "<|endoftext|> <s> </s> <unk>", " ", "\n", "", None, "ﬁ", "é" * 3000, "x" * 20_000]


def test_counts_and_groups(spark, libraries):
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: tuple(r)[1:] for r in al.alignment_counts(docs, A, B).collect()}
    assert [got[i] for i in range(len(texts))] == plain(libraries, texts)


def test_odd_rows(spark, libraries):
    rows = odd_rows()
    got = [tuple(r) for r in al.alignment_counts(odd_table(spark), A, B).collect()]
    want = [(r[0], *p) for r, p in zip(rows, plain(libraries, [r[1] for r in rows]))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    empty = spark.createDataFrame([], SCHEMA)
    assert al.alignment_counts(empty, A, B).count() == 0 and al.align(empty, A, B).count() == 0


def test_overlaps_are_all_pairs_that_share_bytes(spark, libraries):
    texts = odd_texts()[:80]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in al.align(docs, A, B).collect():
        a, b = tokens(libraries, texts[row.doc_id])
        assert row.a_ids == [i for i, *_ in a] and row.b_ids == [i for i, *_ in b]
        want = {(x, y) for x, (_, s, e) in enumerate(a) for y, (_, t, f) in enumerate(b) if max(s, t) < min(e, f)}
        got = list(zip(row.overlap_a, row.overlap_b))
        assert set(got) == want and len(got) == len(want)
        assert list(zip(row.link_a, row.link_b)) == [(x, y) for y, (*_, f) in enumerate(b) for x, (*_, e) in enumerate(a) if e == f]


def test_every_link_has_its_number(sides, libraries):
    pairs = al.Pairs(sides)
    assert len(pairs.keys) < 8 * (len(sides.a_bytes) + len(sides.b_bytes))
    for text in odd_texts():
        found = al.Aligned(sides, [text or ""])
        a, b = found.a.ids[found.link_a], found.b.ids[found.link_b]
        number = pairs.number(a, b)
        assert (pairs.keys[number] == a * pairs.width + b).all()


def test_the_ranked_encoder_equals_the_library(sides, libraries):
    assert sides.fast is not None
    long = [" " * 400_000 + "x", "x" * 400_000, "a " * 200_000, "\n" * 400_000]
    for text in [*filter(None, odd_texts()), "I'll 'S don't\u2003\u2003x ½ Ⅷ ١٢", *long]:
        assert sides._first(" " + text) == libraries[0].encode(" " + text, add_special_tokens=False).ids
    other = json.loads(open(A, encoding="utf-8").read())
    other["model"]["merges"].reverse()
    assert al.ranked(json.dumps(other)) is None


def test_a_batch_equals_single_texts(sides):
    texts = [t or "" for t in odd_texts()]
    widths = len(sides.a_bytes), len(sides.b_bytes)
    table = al.id_texts(*widths)
    together = al.Aligned(sides, texts).written(table, *widths)
    assert together == [al.Aligned(sides, [t]).written(table, *widths)[0] for t in texts]
