"""Benchmark decontamination with suffix arrays over the documents.

Documents are read in shards of a few megabytes. A shard's words become numbers in the
order of the benchmark's vocabulary (0 for any other word and between documents, which
no benchmark word equals), its suffixes are sorted by prefix doubling, and every suffix
of every benchmark item is searched by bisection, all of them at once. The neighbours of
its place give the longest verbatim match; where that reaches a whole window, the range of
suffixes that start with the window gives all its locations. Suffixes in stretches of
known words shorter than the shortest window can't hold one and are left out of the array.

A window is ``window`` consecutive words of an item; a shorter item is one window, an
item without words has none. A document word inside an occurrence of any window is hit.
A document is contaminated if it has a hit and hits are at least 1/``share`` of its words.

The benchmark is dealt into blocks of bounded size, each broadcast by itself, and every
shard is searched for one block after another, so neither its size nor the corpus is
limited by memory.

A null text, of a document or an item, has no words. Repeated items and items of equal id
count once; an item without an id counts under the empty name. Repeated documents are
judged row by row. Empty tables give empty results or clean documents. Columns of other
names are not read; ``clean`` hands them on.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.text import WORD_TABLE, blocks, out_schema, restored, two_columns, with_rows

WINDOW = 13
SHARE = 20
BLOCK_CHARS = 4_000_000


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words: runs of ASCII letters, digits and other non-ASCII characters."""
    return (text or "").encode().translate(WORD_TABLE).split()


class Items:
    """One block of the benchmark: vocabulary, the words of all items, and the suffixes that start with a new window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        vocabulary = sorted({w for _, words in items for w in words})
        self.number = {w: i + 1 for i, w in enumerate(vocabulary)}
        flat: list[int] = []
        distinct: dict[tuple[int, ...], tuple[int, set[str]]] = {}
        for name, words in items:
            ids = [self.number[w] for w in words]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if ids else 0):
                distinct.setdefault(tuple(ids[i : i + size]), (len(flat) + i, set()))[1].add(name)
            flat += [*ids, 0]
        self.flat = np.array([*flat, 0], np.int64)
        self.start = np.array([at for at, _ in distinct.values()], np.int64)
        self.names = [names for _, names in distinct.values()]
        self.size = np.array([len(w) for w in distinct], np.int64)
        self.shortest = int(self.size.min()) if distinct else 0
        self.longest = max((len(words) for _, words in items), default=0)


def suffix_array(numbers: np.ndarray, depth: int) -> np.ndarray:
    """Places of all non-zero suffixes in the order of their first ``depth`` words at least, by prefix doubling."""
    rank, reach = numbers.copy(), 1
    while reach < depth:
        ahead = np.zeros_like(rank)
        if reach < len(rank):
            ahead[:-reach] = rank[reach:]
        ahead[numbers == 0] = 0
        _, rank = np.unique(rank * (int(rank.max()) + 1) + ahead, return_inverse=True)
        reach *= 2
    order = np.argsort(rank, kind="stable")
    return order[numbers[order] > 0]


def common(numbers: np.ndarray, places: np.ndarray, items: Items, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix length of text suffixes and item suffixes, and whether the text's is the smaller one."""
    length = np.zeros(len(places), np.int64)
    smaller = np.zeros(len(places), bool)
    active, at, item = np.arange(len(places)), places, items.start[which]
    while len(active):
        here, there = numbers[np.minimum(at, len(numbers) - 1)], items.flat[item]
        same = (here == there) & (there > 0)
        smaller[active[~same]] = here[~same] < there[~same]
        active, at, item = active[same], at[same] + 1, item[same] + 1
        length[active] += 1
    return length, smaller


def bisect(numbers: np.ndarray, array: np.ndarray, items: Items, which: np.ndarray, whole: bool, above: bool) -> np.ndarray:
    """First place in the suffix array that is not below (``above``: is beyond) each item suffix, or only its window."""
    low, high = np.zeros(len(which), np.int64), np.full(len(which), len(array), np.int64)
    while True:
        left = np.flatnonzero(low < high)
        if not len(left):
            return low
        middle = (low[left] + high[left]) // 2
        length, smaller = common(numbers, array[middle], items, which[left])
        if whole:
            right = smaller
        else:
            inside = length >= items.size[which[left]]
            right = (smaller & ~inside) | (inside & above)
        low[left[right]] = middle[right] + 1
        high[left[~right]] = middle[~right]


def occurrences(numbers: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, window, words matched from there) of every occurrence of a window; the numbers end with a zero."""
    none = np.zeros(0, np.int64)
    if not items.shortest:
        return none, none, none
    zero = np.flatnonzero(numbers == 0)
    runs = np.diff(zero, prepend=-1)  # a run of known words with the zero behind it
    place = np.flatnonzero(np.repeat(runs > items.shortest, runs))
    if not len(place):
        return none, none, none
    kept = numbers[place]
    array = suffix_array(kept, items.longest)
    which = np.arange(len(items.size))
    spot = bisect(kept, array, items, which, True, False)
    longest = np.zeros(len(which), np.int64)
    for neighbour in (spot - 1, spot):
        there = np.flatnonzero((neighbour >= 0) & (neighbour < len(array)))
        longest[there] = np.maximum(longest[there], common(kept, array[neighbour[there]], items, which[there])[0])
    which = which[longest >= items.size]
    first = bisect(kept, array, items, which, False, False)
    n = bisect(kept, array, items, which, False, True) - first
    window = np.repeat(which, n)
    at = array[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    return place[at], window, common(kept, at, items, window)[0]


def search(texts: list[str], blocks_of_items: Iterator[Items]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[str]]]:
    """Words, hit words, words of the longest match and the names of the items found, for each text."""
    words = [words_of(t) for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(counts + 1) - (counts + 1)  # one zero behind every document
    total = int((counts + 1).sum())
    doc_of = np.repeat(np.arange(len(words)), counts + 1)
    change = np.zeros(total + 1, np.int64)
    longest = np.zeros(len(words), np.int64)
    found: list[set[str]] = [set() for _ in words]
    for items in blocks_of_items:
        numbers = np.zeros(total, np.int64)
        get = items.number.get
        for start, n, w in zip(starts.tolist(), counts.tolist(), words):
            numbers[start : start + n] = np.fromiter(map(get, w, repeat(0)), np.int64, n)
        place, window, matched = occurrences(numbers, items)
        np.maximum.at(longest, doc_of[place], matched)
        np.add.at(change, place, 1)
        np.add.at(change, place + items.size[window], -1)
        pairs = np.unique(doc_of[place] * len(items.names) + window) if len(place) else place
        for pair in pairs.tolist():
            found[pair // len(items.names)] |= items.names[pair % len(items.names)]
    hit = np.add.reduceat((np.cumsum(change[:-1]) > 0).astype(np.int64), starts) if total else counts
    return counts, hit, longest, [sorted(f) for f in found]


def item_blocks(benchmark: DataFrame, window: int, block_chars: int, id_col: str, text_col: str) -> list:
    """The benchmark as broadcast blocks of about ``block_chars`` characters; the number of blocks follows its size."""
    context = benchmark.sparkSession.sparkContext
    rows = two_columns(benchmark, id_col, text_col).select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "text")
    rows = rows.distinct()
    chars = rows.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    n = -(-chars // block_chars)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(max(n, 1))))
    out = []
    for block in range(n):
        held = sorted((r["id"], r["text"]) for r in dealt.filter(F.col("block") == block).collect())
        out.append(context.broadcast(Items([(name, words_of(text)) for name, text in held], window)))
    return out


def _searched(source: DataFrame, benchmark: DataFrame, window: int, block_chars: int, item_id: str, item_text: str) -> DataFrame:
    shared = item_blocks(benchmark, window, block_chars, item_id, item_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in blocks(batches):
            n, hit, longest, names = search(texts, (b.value for b in shared))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(n), pa.array(hit), pa.array(longest), pa.array(names, pa.list_(pa.string()))],
                ["id", "n_words", "n_hit", "longest", "items"],
            )

    return source.mapInArrow(run, out_schema(source, n_words="long", n_hit="long", longest="long", items="array<string>"))


def _judged(share: int):
    return (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, block_chars: int = BLOCK_CHARS,
    id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(id, n_words, n_hit, longest, items, contaminated) of every document; longest: words of the longest match."""
    out = _searched(two_columns(docs, id_col, text_col), benchmark, window, block_chars, item_id, item_text)
    return out.withColumn("contaminated", _judged(share)).withColumnRenamed("id", id_col)


def clean(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, block_chars: int = BLOCK_CHARS,
    text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    out = _searched(with_rows(docs, text_col), benchmark, window, block_chars, item_id, item_text)
    return restored(out.filter(~_judged(share)), docs.columns)


_CAPITALS = "".join(map(chr, range(0x41, 0x5B)))


def _sql_words(column: str) -> str:
    lower = f"translate(coalesce({column}, ''), '{_CAPITALS}', '{_CAPITALS.lower()}')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


ORACLE = f"""
WITH d AS (SELECT doc_id, {_sql_words('text')} AS w FROM documents),
b AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_sql_words('text')} AS w FROM benchmark),
s AS (SELECT item, w, least({WINDOW}, len(w)) AS n FROM b WHERE len(w) > 0),
si AS (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM s),
win AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k FROM si),
sizes AS (SELECT DISTINCT n FROM win),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
dk AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k FROM di),
hit AS (SELECT doc_id, dk.n, i, item FROM dk JOIN win ON dk.n = win.n AND dk.k = win.k),
place AS (SELECT DISTINCT doc_id, n, i FROM hit),
pos AS (SELECT doc_id, unnest(range(i, i + n)) AS p FROM place),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""
