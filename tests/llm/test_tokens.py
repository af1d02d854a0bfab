"""Byte-level BPE and token counts against the public libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from edges import SCHEMA, odd_rows, odd_table
from retention.llm import bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(seed, n, alphabet):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


TEXTS = [
    *texts(1, 4000, " \n\t  ''sstmdrevel1a9.!é　日\x1c\x85½²"),
    *texts(2, 1000, [chr(c) for c in range(32, 0x2FFF)] + [chr(c) for c in range(0x10000, 0x1FFFF)]),
    "a" * 5000, "'" * 30 + "s", " " * 700 + "x", "\n" * 1300, "", "<|endoftext|>",
]


def split_back(ids, offsets):
    return [ids[offsets[i] : offsets[i + 1]].tolist() for i in range(len(offsets) - 1)]


def test_encoding_equals_the_library(ranks, library):
    ids, ends, offsets = bpe.Encoder(ranks).encode(TEXTS)
    assert split_back(ids, offsets) == [library.encode_ordinary(t) for t in TEXTS]
    assert [ends[o - 1] if o > p else 0 for p, o in zip(offsets, offsets[1:])] == [len(t.encode()) for t in TEXTS]


def test_a_small_cache_changes_nothing(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 50)
    monkeypatch.setattr(bpe, "MOST_IDS", 2000)
    encoder = bpe.Encoder(ranks)
    for lo in range(0, 2000, 40):
        part = TEXTS[lo : lo + 40]
        ids, _, offsets = encoder.encode(part)
        assert split_back(ids, offsets) == [library.encode_ordinary(t) for t in part]


def test_scan_in_blocks_equals_one_step_at_a_time():
    read = np.random.default_rng(1).integers(0, 9, 5000).astype(np.uint8)
    state, want = bpe.FRESH, []
    for s in read:
        want.append(bool(bpe.STARTS[state, s]))
        state = bpe.STEP[state, s]
    assert bpe.boundaries(read).tolist() == want


def test_digests_of_odd_rows(spark, library):
    got = sorted(map(tuple, bpe.digests(odd_table(spark), RANKS).collect()), key=repr)
    want = []
    for row in odd_rows():
        text = row[1] or ""
        ids = library.encode_ordinary(text)
        joined = ",".join(map(str, ids)).encode()
        want.append((row[0], len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_counts_equal_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counter = token_counts.Counter(token_counts.read_pieces(MODEL))
    more = texts(3, 4000, "  ▁▁athe of\nin<s>é日")
    for text in [*TEXTS, *more]:
        assert counter.count(text) == len(model.encode(text)), repr(text)


def test_counts_of_odd_rows(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = sorted(map(tuple, token_counts.token_counts(odd_table(spark), MODEL, limit=100).collect()), key=repr)
    want = []
    for row in odd_rows():
        text = row[1] or ""
        n = len(model.encode(text))
        want.append((row[0], len(text.encode()), n, n > 100))
    assert got == sorted(want, key=repr)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.digests(empty, RANKS).count() == 0
    assert token_counts.token_counts(empty, MODEL).count() == 0
