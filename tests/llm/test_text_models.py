"""Language model, quality classifier, licences, personal data and decontamination."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from edges import SCHEMA, odd_rows, odd_table
from retention.llm import decontaminate, licenses, lm_mixing, pii, quality


def plain(rows):
    return sorted(map(tuple, rows), key=repr)


# --- language model -------------------------------------------------------------------------------------------


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def learns(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2


@pytest.mark.parametrize("frequent", [1 << 18, 4])
def test_unigram_base(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_mixing, "FREQUENT", frequent)
    rows = odd_rows()
    counts = Counter(w for r in rows if learns(r[0]) for w in tokens(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for r in rows:
        words = tokens(r[1])
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        want.append((r[0], not learns(r[0]), len(words), sum(counts[w] > 0 for w in words), total, round(base, 6)))
    got = lm_mixing.score_texts(odd_table(spark)).collect()
    assert plain((*list(g)[:5], round(g["base_score"], 6)) for g in got) == plain(want)
    assert all(g["score"] < 0 and math.isfinite(g["score"]) and g["bits_per_byte"] > 0 for g in got)


def small_model(texts):
    lines = [lm_mixing.canonical(t)[1] for t in texts]
    code = lm_mixing.Code(np.bincount(np.frombuffer(b"".join(lines), np.uint8), minlength=256))
    tables = [np.zeros(lm_mixing.SYMBOLS << bits, np.int64) for bits in lm_mixing.ORDERS.values()]
    shifted, _, _ = lm_mixing.laid_out(lines, code)
    known = np.flatnonzero(shifted)
    for table, context in zip(tables, lm_mixing.contexts(shifted, lm_mixing.ORDERS)):
        np.add.at(table, context[known] * lm_mixing.SYMBOLS + shifted[known] - 1, 1)
    odds = [lm_mixing.log_odds(t.reshape(-1, lm_mixing.SYMBOLS), code).reshape(-1) for t in tables]
    return lm_mixing.Model(code, odds, {}, 1, 1)


def test_probabilities_add_up_to_one():
    model = small_model(["the cat sat on the mat", "the dog sat on the log", "zürich äö 123"])
    for prefix in (b"", b"the ", b"the cat s"):
        lines = [prefix + bytes([b]) for b in range(256)]
        before = 10 ** model.score([prefix])[0] if prefix else 1.0
        assert np.isclose((10 ** model.score(lines)).sum() / before, 1, rtol=1e-4)


def test_scores_do_not_depend_on_neighbours():
    texts = [t for t in (r[1] for r in odd_rows()) if t]
    model = small_model(texts)
    lines = [lm_mixing.canonical(t)[1] for t in texts]
    assert np.allclose(model.score(lines), [model.score([line])[0] for line in lines], rtol=1e-5)


def test_adapting_helps_and_seen_text_is_cheaper():
    rnd = random.Random(3)
    seen = ["".join(rnd.choice("abcde ") for _ in range(300)) for _ in range(20)]
    model = small_model(seen)
    fresh = ["".join(rnd.choice("abcde ") for _ in range(300)) for _ in range(20)]
    score = lambda texts: model.score([lm_mixing.canonical(t)[1] for t in texts]).mean()
    assert score(seen) > score(fresh)


def test_weights_change_within_a_short_text(monkeypatch):
    model = small_model(["the cat sat on the mat", "the dog sat on the log"])
    line = lm_mixing.canonical("the cat sat on the log")[1]
    adapted = model.score([line, line[:2]])
    monkeypatch.setattr(lm_mixing, "RATE", 0.0)
    fixed = model.score([line, line[:2]])
    assert not np.isclose(adapted[0], fixed[0], rtol=1e-4) and not np.isclose(adapted[1], fixed[1], rtol=1e-6)


def test_held_out_texts_are_not_learnt(spark):
    rows = [(i, f"word{i % 7} and word{i % 3}") for i in range(60)]
    changed = [(i, t if learns(i) else "entirely different words here") for i, t in rows]
    a, b = ({r["doc_id"]: r for r in lm_mixing.score_texts(spark.createDataFrame(x, "doc_id long, text string")).collect()} for x in (rows, changed))
    assert all(a[i] == b[i] for i in a if learns(i))


def test_no_two_contexts_share_counts(spark, monkeypatch):
    rnd = random.Random(11)
    texts = {i: "".join(rnd.choice("abcdefgh ") for _ in range(3000)) for i in range(120)}
    got = {r["doc_id"]: r["score"] for r in lm_mixing.score_texts(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    lines = {i: lm_mixing.canonical(t)[1] for i, t in texts.items()}
    learnt = [line for i, line in lines.items() if learns(i)]
    code = lm_mixing.Code(np.bincount(np.frombuffer(b"".join(learnt), np.uint8), minlength=256))
    shifted, _, _ = lm_mixing.laid_out(learnt, code)
    raw, rows, odds = shifted.tobytes(), [], []
    for order in lm_mixing.ORDERS:
        seen = {}
        for i in np.flatnonzero(shifted).tolist():
            seen.setdefault(raw[i - order : i], Counter())[raw[i] - 1] += 1
        counts = np.zeros((len(seen) + 1, lm_mixing.SYMBOLS), np.int64)  # the first row is for contexts never seen
        for row, found in enumerate(seen.values(), 1):
            for symbol, n in found.items():
                counts[row, symbol] = n
        rows.append({c: row for row, c in enumerate(seen, 1)})
        odds.append(lm_mixing.log_odds(counts, code).reshape(-1))

    def exact(shifted, orders):
        raw = shifted.tobytes()
        return [np.array([r.get(raw[i - o : i], 0) if i >= o else 0 for i in range(len(raw))], np.int32) for o, r in zip(orders, rows)]

    monkeypatch.setattr(lm_mixing, "contexts", exact)
    some = [*range(8), *[i for i in texts if not learns(i)][:8]]
    want = lm_mixing.Model(code, odds, {}, 1, 1).score([lines[i] for i in some])
    assert np.allclose([got[i] for i in some], want, rtol=1e-5)


def test_pairs_are_packed_without_loss(monkeypatch):
    monkeypatch.setattr(lm_mixing, "KEYS_BLOCK", 50)
    lines = [lm_mixing.canonical(t)[1] for t in ("the cat sat on the mat", "", "zürich äö 123", "the cat sat on the log " * 40)]
    code = lm_mixing.Code(np.bincount(np.frombuffer(b"".join(lines), np.uint8), minlength=256))
    pairs = lm_mixing.in_parts(lm_mixing.pair_keys, lines, code, np.uint64)
    contexts = {(bytes(8) + line)[i : i + 9] for line in lines for i in range(len(line))}
    symbols = {bytes(0 if b == 0 else int(code.symbol[b]) + 1 for b in c) for c in contexts}
    distinct = np.unique(pairs)
    assert len(pairs) == sum(map(len, lines)) and len(distinct) == len(symbols)
    assert np.array_equal(lm_mixing.of_levels(lm_mixing.unpacked(lm_mixing.packed(*lm_mixing.levels_of(distinct)), *lm_mixing.LEVEL_KINDS)), distinct)
    numbers, place = lm_mixing.numbered(pairs)
    assert np.array_equal(numbers, distinct) and np.array_equal(numbers[place], pairs)


def test_rounds_and_merged_blocks_change_no_score(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(i, "".join(rnd.choice("abcd ") for _ in range(rnd.choice([5, 300, 4000])))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    whole = {r["doc_id"]: r["score"] for r in lm_mixing.score_texts(docs).collect()}
    for name, value in (("CHUNK", 20_000), ("BUCKET", 10_000), ("LEARNT_BLOCK", 5_000), ("KEYS_BLOCK", 1_000), ("MERGED", 500), ("SLICE", 64), ("WINDOW", 100)):
        monkeypatch.setattr(lm_mixing, name, value)
    parts = {r["doc_id"]: r["score"] for r in lm_mixing.score_texts(docs).collect()}
    assert whole.keys() == parts.keys() and np.allclose([whole[i] for i in whole], [parts[i] for i in whole], rtol=1e-6)


def test_no_shuffle_of_contexts_stays_on_disk(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        found = files.getAllFiles()
        return {str(f): f.length() for f in (found.apply(i) for i in range(found.size())) if "shuffle_" in str(f)}

    rnd = random.Random(9)
    rows = [(i, "".join(rnd.choice("abcdefgh ") for _ in range(3000))) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = held()
    scored = lm_mixing.score_texts(docs)
    left = sum(size for name, size in held().items() if name not in before)
    assert left < 50_000  # 300,000 bytes of text; their contexts take far more
    assert scored.count() == len(rows)


def test_language_model_without_rows_or_training(spark):
    assert lm_mixing.score_texts(spark.createDataFrame([], SCHEMA)).count() == 0
    held = next(i for i in range(100) if not learns(i))
    got = lm_mixing.score_texts(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert len(got) == 1 and got[0]["train_tokens"] == 0 and got[0]["n_known"] == 0 and got[0]["base_score"] == 0.0
    assert math.isfinite(got[0]["score"])


# --- quality --------------------------------------------------------------------------------------------------


def quality_rows(n=300):
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.7
        text = " ".join(rnd.choice(words) if good else rnd.choice(words).upper() + "!!" for _ in range(rnd.randint(5, 60)))
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_on_held_out_rows(spark):
    rows, labels = quality_rows()
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weights = quality.train(docs, known, may_train=quality.not_held_out())
    got = {r["doc_id"]: r for r in quality.score(docs, weights).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["predicted"] == labels[i][1] for i in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    flipped = [(i, q if zlib.crc32(str(i).encode()) % 5 else 1 - q, t) for i, q, t in labels]
    again = quality.train(docs, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"), may_train=quality.not_held_out())
    assert np.allclose(np.delete(weights, -1), np.delete(again, -1))
    bounded = quality.train(docs, known, max_rows=100)
    assert np.mean([r["predicted"] == labels[r["doc_id"]][1] for r in quality.score(docs, bounded).collect()]) > 0.9


def test_quality_sees_how_words_are_combined(spark):
    rnd = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        good, pairs = rnd.random() < 0.5, ["red car", "blue sky"] if i % 2 else ["old tree", "new house"]
        if not good:  # the same words and shapes, combined otherwise
            first, second = zip(*(p.split() for p in pairs))
            pairs = [f"{a} {b}" for a, b in zip(first, reversed(second))]
        rows.append((i, " and ".join(rnd.sample(pairs, 2) * rnd.randint(1, 4))))
        labels.append((i, int(good), 0))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weights = quality.train(docs, known, may_train=quality.not_held_out())
    got = {r["doc_id"]: r["score"] >= 0.5 for r in quality.score(docs, weights).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i] == labels[i][1] for i in held) >= 0.97 * len(held)


def test_quality_of_odd_rows_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    weights = quality.train(odd_table(spark), none)
    assert {r["score"] for r in quality.score(odd_table(spark), weights).collect()} == {0.5}
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    weights = quality.train(odd_table(spark), odd)
    assert quality.score(odd_table(spark), weights).count() == len(odd_rows())
    kept = quality.keep(odd_table(spark), weights, threshold=0.0)
    assert kept.columns == odd_table(spark).columns and plain(kept.collect()) == plain(odd_rows())
    assert quality.score(spark.createDataFrame([], SCHEMA), weights).count() == 0


# --- licences -------------------------------------------------------------------------------------------------


def test_phrase_places(spark):
    rnd = random.Random(5)
    vocabulary = [w.decode() for w in licenses.vocabulary()] + ["foo", "é"]
    pieces = [*(p for p, _ in licenses.PHRASES), "cc-by-nc", "Apache License, version 2", "all rights reserved"]
    texts = [" ".join(rnd.choice(pieces if rnd.random() < 0.3 else vocabulary) for _ in range(rnd.randint(0, 25))) for _ in range(400)]
    rows = [(i, t, *[None] * 7) for i, t in enumerate(texts)] + odd_rows()
    got = licenses.scan_licenses(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    want = []
    for r in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        starts, labels = [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            places = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            starts += places
            labels |= {label} if places else set()
        want.append((r[0], len(words), sorted(starts), sorted(labels)))
    assert plain((g["doc_id"], g["n_words"], g["starts"], g["base_labels"]) for g in got) == plain(want)
    assert all(set(g["base_labels"]) <= set(g["labels"]) and 0 <= g["score"] <= 1 for g in got)


def test_templates_need_their_key_phrases(spark):
    texts = {
        0: "This work is licensed under the GNU General Public License, version 3.",
        1: "licensed under the gnu general secret license version 3",
        2: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
           "files (the Software), to deal in the Software without restriction",
        3: "permission is granted to copy",
    }
    got = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == {0: ["gpl-3"], 1: [], 2: ["mit"], 3: []}


# --- personal data --------------------------------------------------------------------------------------------

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def spans_brute(text):
    out = []
    for k, (name, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": name == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[name]
            if good:
                out.append((m.start(), k, m.end(), name))
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(out))


def pii_rows():
    rnd = random.Random(2)
    odd = ["".join(rnd.choice("0123 45-+.()@ab é日\n%") for _ in range(rnd.randint(0, 60))) for _ in range(800)]
    odd += ["1" * 20000, "a" * 20000 + "@x.y", "1 " * 5000, "+1" + "(" * 9000, "a@b.cd+x@y.z", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "0255.1.1.1 256.1.1.1"]
    return [(1000 + i, t, *[None] * 7) for i, t in enumerate(odd)] + odd_rows()


def test_base_spans(spark):
    rows = [r for r in pii_rows() if r[1] != "same id, other text"]
    got = pii.digests(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    want = []
    for r in rows:
        spans = spans_brute(r[1] or "")
        counts = Counter(s.split(":")[0] for s in spans.split(",") if s)
        want.append((r[0], *[counts[k] for k, _ in BASE], hashlib.sha256(spans.encode()).hexdigest()))
    assert plain(tuple(g)[:6] for g in got) == plain(want)


def test_base_spans_stay_and_named_ones_are_added(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(300):
        a, b, c = (rnd.randint(100, 999) for _ in range(3))
        rows.append((i, f"write an email to ann{a}@mail.example.com or call the phone +1 ({a}) {b}-{c}{c % 10} now {a * b * c}"))
    rows += [(900, "please call me: 555-123-4567 today"), (901, "mail joe (at) example (dot) com"), (902, "version 300.1.2.3 of 4111111111111112")]
    got = {r["doc_id"]: r["spans"] for r in pii.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert {s for s in spans_brute(text).split(",") if s} <= set(got[i].split(","))
    assert "phone:16:28" in got[900] and "email:5:31" in got[901] and got[902] == ""


def test_no_candidates_and_no_rows(spark):
    got = pii.digests(spark.createDataFrame([(1, "nothing"), (2, None)], "doc_id long, text string")).collect()
    assert [tuple(r)[1:5] + (r["spans"],) for r in got] == [(0, 0, 0, 0, "")] * 2
    assert pii.digests(spark.createDataFrame([], SCHEMA)).count() == 0


# --- decontamination ------------------------------------------------------------------------------------------


def contamination_brute(text, items, window):
    words = decontaminate.words_of(text)
    hit, found = [0] * len(words), set()
    for name, item in items:
        item_words = decontaminate.words_of(item)
        size = min(window, len(item_words))
        for a in range(len(item_words) - size + 1 if item_words else 0):
            for b in range(len(words) - size + 1):
                if words[b : b + size] == item_words[a : a + size]:
                    found.add(name)
                    hit[b : b + size] = [1] * size
    return len(words), sum(hit), sorted(found)


def test_search_equals_brute_force():
    rnd = random.Random(3)
    for _ in range(150):
        vocabulary = ["a", "b", "c", "dé", "e1"][: rnd.randint(1, 5)]
        some = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
        items = [(str(i), some(rnd.randint(0, 9))) for i in range(rnd.randint(0, 6))]
        docs = [some(rnd.randint(0, 30)) + rnd.choice(["", " zz " + some(5)]) for _ in range(rnd.randint(1, 6))]
        dealt = [decontaminate.Items([(n, decontaminate.words_of(t)) for n, t in items[k : k + 2]], 4) for k in range(0, len(items), 2)]
        n, hit, longest, names = decontaminate.search(docs, iter(dealt))
        for k, doc in enumerate(docs):
            want = contamination_brute(doc, items, 4)
            assert (n[k], hit[k], names[k]) == want
            assert (longest[k] >= 1) == (want[1] > 0)


def test_contamination_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long), (2, "The, the"), (3, None), (4, ""), (1, long), (None, "mit license"), (12, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17 w18")]
    rows = [*odd_rows(), (700, "x " * 300 + long, *[None] * 7), (701, "x " * 3000 + long, *[None] * 7), (702, long[3:60], *[None] * 7)]
    docs, bench = spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(items, "item_id long, text string")
    named = [("" if i is None else str(i), t) for i, t in items]
    want = []
    for r in rows:
        n, hit, found = contamination_brute(r[1], named, 13)
        want.append((r[0], n, hit, found, hit > 0 and 20 * hit >= n))
    for chars in (4_000_000, 30):
        got = decontaminate.contamination(docs, bench, block_chars=chars)
        assert plain((g["doc_id"], g["n_words"], g["n_hit"], g["items"], g["contaminated"]) for g in got.collect()) == plain(want)
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns
    assert plain(clean.collect()) == plain(r for r, w in zip(rows, want) if not w[4])
    none = decontaminate.contamination(docs, bench.limit(0))
    assert none.filter("contaminated or n_hit > 0").count() == 0
    assert decontaminate.contamination(spark.createDataFrame([], SCHEMA), bench).count() == 0
