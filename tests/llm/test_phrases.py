"""Phrase counts and collocations against plain loops, and the query against its SQL."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from compare import duck
from edges import SCHEMA, odd_rows, odd_table
from retention.llm import phrases as ph
from retention.llm import queries

WORDS = ["new", "York", "york", "city", "of", "the", "The", "é", "É", "日本", "a.b", "x\x00y", "\x1c", "<s>"]


def pieces(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", lower)]


def plain_counts(rows, longest=3):
    counts, left, right = Counter(), Counter(), Counter()
    for lang, text in rows:
        for w in pieces(text):
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    key = ("und" if lang is None else lang, " ".join(w[i : i + size]), size)
                    counts[key] += 1
                    left[key] += i > 0
                    right[key] += i + size < len(w)
    out = {k: (n, left[k], right[k]) for k, n in counts.items()}
    totals = Counter()
    for (lang, _, size), (n, *_) in out.items():
        totals[lang] += n * (size == 1)
    return out | {(lang, "", 0): (n, n, n) for lang, n in totals.items()}


def plain_collocations(rows, longest=3, least=10, top=2000, share=50):
    f = {(lang, p): n for (lang, p, size), (n, *_) in plain_counts(rows, longest).items() if size}
    total = Counter()
    for (lang, p), n in f.items():
        total[lang] += n * (" " not in p)
    candidates = {(lang, tuple(p.split(" "))): n for (lang, p), n in f.items() if " " in p and n >= least}
    out = {}
    for (lang, w), a in candidates.items():
        longer = [
            b for (m, v), b in candidates.items()
            if m == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
        ]
        if any(100 * b >= share * a for b in longer):
            continue
        best = None
        for k in range(1, len(w)):
            l, r = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            score = 1000000 * a * a // (l * r)
            if best is None or score < best[0]:
                best = (score, l, r)
        out.setdefault(lang, []).append((-best[0], -a, " ".join(w).encode(), best[1], best[2]))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, total[lang], -s)
        for lang, found in out.items()
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])
    )


def texts(seed, n=200):
    rnd = random.Random(seed)
    glue = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", " ! ", "\x0b"]
    out = []
    for _ in range(n):
        out.append((rnd.choice(["en", "de", None, ""]), "".join(rnd.choice(WORDS) + rnd.choice(glue) for _ in range(rnd.randint(0, 60)))))
    return [*out, ("en", None), (None, ""), ("en", "a " * 3000), ("en", "." * 50), ("xx", "one")]


def test_intervals_of_the_index():
    rnd = np.random.default_rng(3)
    for n in (1, 2, 5, 60, 400):
        ids = np.append(rnd.integers(0, 5, n), 0)
        found = {}
        for grams in ph.ngrams(ids, 4):
            assert len({tuple(w) for w in grams.words.tolist()}) == len(grams.words)
            for w, *numbers in zip(grams.words.tolist(), grams.counts, grams.left, grams.right):
                found[tuple(w)] = tuple(map(int, numbers))
        want, left, right = Counter(), Counter(), Counter()
        line = ids.tolist()
        for size in range(1, 5):
            for i in range(len(line) - size + 1):
                w = tuple(line[i : i + size])
                if 0 not in w:
                    want[w] += 1
                    left[w] += i > 0 and line[i - 1] > 0
                    right[w] += line[i + size] > 0
        assert found == {w: (c, left[w], right[w]) for w, c in want.items()}


def test_counts_do_not_depend_on_shards(spark, monkeypatch):
    rows = texts(1)
    want = plain_counts(rows, 4)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for limit in (100, 8_000_000):
        monkeypatch.setattr(ph, "SHARD_BYTES", limit)
        got = {(r.lang, r.phrase, r.words): (r.n, r.with_left, r.with_right) for r in ph.phrase_counts(docs, 4).collect()}
        assert got == want
        frequent = {k: v for k, v in want.items() if v[0] >= 7 or not k[2]}
        for few in (0, ph.FEW_HASHES):  # joined, broadcast
            got = {(r.lang, r.phrase, r.words): (r.n, r.with_left, r.with_right) for r in ph.phrase_counts(docs, 4, 7, few_hashes=few).collect()}
            assert got == frequent


def test_many_hashes_are_a_bitmap(spark, monkeypatch):
    rnd = np.random.default_rng(5)
    hashes = rnd.integers(-(2**63), 2**63 - 1, 3000)
    table = spark.createDataFrame([(int(h),) for h in hashes], "h long").repartition(4)
    bits = ph.bitmap(table, 3000)
    assert len(bits) * 8 == 1 << 16 and ph.set_in(bits, hashes).all()
    assert ph.set_in(bits, rnd.integers(-(2**63), 2**63 - 1, 20_000)).mean() < 0.06
    monkeypatch.setattr(ph, "MOST_BITS", ph.LEAST_BITS)  # a fuller bitmap keeps more rare ones, and loses none
    assert len(ph.bitmap(table, 3000)) * 8 == ph.LEAST_BITS and ph.set_in(ph.bitmap(table, 3000), hashes).all()


def test_many_hashes_hold_rare_words_back(spark, monkeypatch):
    docs = spark.createDataFrame([("en", f"the cat w{i} sat x{i} y{i}") for i in range(500)], "lang string, text string").repartition(3)
    found = ph.phrase_counts(docs, 3, 7, few_hashes=0)
    assert "Join" not in found._jdf.queryExecution().toString()  # not joined behind a shuffle of all n-grams
    assert {r.phrase: r.n for r in found.collect()} == {"": 3000, "the": 500, "cat": 500, "sat": 500, "the cat": 500}


@pytest.mark.parametrize("options", [{}, {"least": 2}, {"least": 3, "longest": 4, "share": 30}, {"least": 2, "top": 5}])
def test_collocations(spark, options):
    rows = texts(2)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in ph.collocations(docs, **options).collect())
    assert got == plain_collocations(rows, **options) and got


def test_odd_rows(spark):
    names = SCHEMA.split(", ")
    at = [i for i, c in enumerate(names) if c.split(" ")[0] in ("source", "text")]
    rows = [(r[at[1]], r[at[0]]) for r in odd_rows()]
    got = sorted(tuple(r) for r in ph.collocations(odd_table(spark), lang_col="source").collect())
    assert got == plain_collocations(rows)
    assert ph.collocations(spark.createDataFrame([], SCHEMA), lang_col="source").count() == 0


def test_words_of_many_ids_are_ranked_again():
    rnd = np.random.default_rng(4)
    ids = np.append(rnd.integers(0, 2**20, 3000) * (rnd.random(3000) < 0.9), 0)
    _, small = np.unique(ids, return_inverse=True)
    a, b = ph.FMIndex(ids, 5), ph.FMIndex(small, 5)
    assert (np.unique(ids)[b.bwt] == a.bwt).mean() > 0.99  # only rows alike in five words may swap places


def test_products_beyond_64_bits(spark):
    score = spark.sql(
        "SELECT (1000000 * (CAST(a AS DECIMAL(16, 0)) * CAST(a AS DECIMAL(16, 0)))) DIV (CAST(l AS DECIMAL(16, 0)) * CAST(r AS DECIMAL(16, 0)))"
        " FROM VALUES (900000000001L, 900000000007L, 1000000000039L) AS t(a, l, r)"
    ).first()[0]
    assert score == 1000000 * 900000000001**2 // (900000000007 * 1000000000039)


def test_query_equals_its_sql(spark, sf_dir):
    got = queries.op12_phrases(spark, sf_dir)
    want = duck(sf_dir).sql(ph.ORACLE)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())
