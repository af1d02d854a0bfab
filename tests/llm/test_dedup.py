"""Exact, line and near dedup against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from edges import SCHEMA, odd_rows, odd_table
from retention.llm import exact_dedup, line_dedup, simhash
from retention.llm.components import components

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def plain(rows):
    return sorted(map(tuple, rows), key=repr)


def exact_brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[(row[1] or "").translate(LOWER)].append(row[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        stays = ids.index(keep)
        out += [(i, keep, len(ids), k == stays, digest) for k, i in enumerate(ids)]
    return out


def test_exact_duplicates(spark):
    rows = [*odd_rows(), (900, "THE É", *[None] * 7), (901, "the É", *[None] * 7), (902, "the é", *[None] * 7), (903, "a" * 5000, *[None] * 7)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for least, most in ((1024, 8192), (3, 9)):
        assert plain(exact_dedup.exact_duplicates(table, least=least, most=most).collect()) == plain(exact_brute(rows))


def test_chunks_put_a_text_together_again(spark):
    texts = [t for t in (r[1] for r in odd_rows()) if t]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    for least, most in ((1024, 8192), (2, 5)):
        cut = table.select("text", F.regexp_extract_all("text", F.lit(exact_dedup.chunk_pattern(least, most)), F.lit(0)).alias("c"))
        assert all("".join(r["c"]) == r["text"] for r in cut.collect())


def test_a_shared_key_does_not_make_chunks_equal(spark):
    chunks = spark.createDataFrame([(1, b"x", 0), (1, b"y", 0), (1, b"x", 5), (2, b"x", 0)], "key long, digest binary, salt long")
    got = {(r["key"], bytes(r["digest"]), r["salt"]): r["rank"] for r in exact_dedup.identifiers(chunks).collect()}
    assert got == {(1, b"x", 0): 0, (1, b"x", 5): 0, (1, b"y", 0): 1, (2, b"x", 0): 0}


def lines_brute(rows, sites):
    spread, least = defaultdict(set), {}
    for row in rows:
        for line in (row[1].split("\n") if row[1] is not None else []):
            if line.strip(" "):
                if row[2] is not None:
                    spread[line].add(row[2])
                least[line] = min((x for x in (least.get(line), row[0]) if x is not None), default=None)
    out = []
    for row in rows:
        if row[1] is None:
            out.append((row[0], 0, 0, None))
            continue
        lines = row[1].split("\n")
        kept = [x for x in lines if not (x.strip(" ") and len(spread[x]) >= sites and row[0] != least[x])]
        out.append((row[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup(spark):
    rnd = random.Random(4)
    common = [f"shared line {i}" for i in range(30)] + ["", "  "]
    rows = []
    for i in range(400):
        lines = [rnd.choice(common[: rnd.randint(1, 32)]) if rnd.random() < 0.6 else f"own {i} {j}" for j in range(rnd.randint(1, 8))]
        rows.append((i, "\n".join(lines), f"site{rnd.randint(0, 30)}", *[None] * 6))
    rows += [*odd_rows(), rows[5]]
    rows = [r for r in rows if not (r[0] == 3 and r[1] == "same id, other text")]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for sites in (2, 10, 25):
        got = line_dedup.remove_lines(table, sites=sites, counts=True)
        assert plain(got.collect()) == plain(lines_brute(rows, sites))


def test_line_dedup_keeps_columns(spark):
    got = line_dedup.remove_lines(odd_table(spark), sites=100)
    assert got.columns == odd_table(spark).columns
    assert plain(got.collect()) == plain(odd_rows())


def fingerprint_brute(text):
    words = [w for w in text.encode().lower().split()]
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_brute(nodes, radius):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    listed = list(nodes)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def near_brute(rows):
    prints = [fingerprint_brute(r[1] or "") for r in rows]
    root = classes_brute(set(prints), 2)
    least = {}
    for row, p in zip(rows, prints):
        least[root[p]] = min((x for x in (least.get(root[p]), row[0]) if x is not None), default=None)
    return [(r[0], f"{p:016x}", least[root[p]]) for r, p in zip(rows, prints)]


def test_majorities_are_counted_exactly():
    rnd = random.Random(5)
    for n in (1, 2, 3, 5, 64, 777):
        values = [rnd.getrandbits(64) for _ in range(n)]
        want = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > n)
        assert simhash.column_majorities(np.array(values, np.uint64)) == want


def test_near_duplicates_of_odd_rows(spark):
    rows = odd_rows()
    long = "alpha beta gamma delta " * 400
    rows += [(800 + i, long + f"tail{i}", *[None] * 7) for i in range(12)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert plain(got.collect()) == plain(near_brute(rows))


def clustered(seed, n):
    rnd = random.Random(seed)
    out = set()
    for _ in range(n // 60):
        center = rnd.getrandbits(64)
        low = rnd.choice([8, 20, 64])
        for _ in range(60):
            out.add(center ^ (1 << rnd.randrange(low)) ^ (1 << rnd.randrange(low)) ^ (1 << rnd.randrange(64)))
    return sorted(out)


def test_links_in_small_and_large_shards(spark):
    values = clustered(6, 900)
    signed = [(v - (v >> 63 << 64),) for v in values]
    prints = spark.createDataFrame(signed, "fp long")
    want = classes_brute(values, 2)
    sizes = defaultdict(int)
    for v in values:
        sizes[want[v]] += 1
    for shard in (1, 8, 10_000):
        found = components(simhash.links(prints, shard_size=shard)).collect()
        unsigned = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in found}
        groups, wanted = defaultdict(set), defaultdict(set)
        for v in values:
            groups[unsigned.get(v, v)].add(v)
            wanted[want[v]].add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(200)}


def test_first_of_classes(spark):
    rows = odd_rows()
    got = simhash.first_of_classes(odd_table(spark))
    assert got.columns == odd_table(spark).columns
    root = classes_brute({fingerprint_brute(r[1] or "") for r in rows}, 2)
    of = [root[fingerprint_brute(r[1] or "")] for r in rows]
    least = {c: min((r[0] for r, x in zip(rows, of) if x == c and r[0] is not None), default=None) for c in of}
    assert sorted((r["doc_id"] for r in got.collect()), key=repr) == sorted(least.values(), key=repr)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert line_dedup.remove_lines(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.first_of_classes(empty).count() == 0
