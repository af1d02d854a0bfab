"""Phrase collocations: the word n-grams of a corpus with exact counts, and the best phrases per language.

Every task cuts its texts into shards of about ``SHARD_BYTES`` and builds an FM-index over word ids for
every language of a shard, one of the words read forwards and one of them read backwards. Starting with
the interval of every word, an interval is extended by all words that stand before its occurrences; the
place of the longer n-gram among the reversed ones is kept beside it, so that extensions to the right
are counted there. Rows are sorted by as many words as the longest n-gram has: the intervals of n-grams
up to that length are the same as with whole suffixes.

The shards' counts are added up by language and n-gram. Most n-grams are rare, so where only frequent
ones are asked for, a first pass adds up the counts of words and pairs by a 64-bit hash: a sum below the
limit proves that a word or pair is rare, and with it every n-gram that holds it. The second pass extends
only what is left, by pairs that are left, and sends words. Two pairs of one hash may both be left over
and fall at their own counts. The hashes left are broadcast after they were counted (at most
``FEW_HASHES``); if there are more, they set the bits of a bitmap that Spark puts together, and the bitmap
of at most ``MOST_BITS`` is broadcast. A rare pair that meets a set bit falls at its own count, too.

A null language counts as ``und``; a null or empty text has no words; repeated rows and rows of equal id
count each; an empty table gives an empty table. Columns other than the language and the text are not
read. A long text is one shard's part as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retention.llm.text import blocks
from retention.sources.staging import broadcast_if_small, stage_for_now

SHARD_BYTES = 8_000_000
BATCH_ROWS = 50_000
FEW_HASHES = 8_000_000
BITS_PER_HASH, LEAST_BITS, MOST_BITS = 16, 1 << 15, 1 << 29  # powers of two, 4 kB to 64 MB
SIEVED = 2
SALTS = 64
NO_LANG = "und"
LONGEST, LEAST, TOP, SHARE = 3, 10, 2000, 50
#: Lower-cases A-Z, makes the ends of pieces full stops and tabs blanks; a full stop is then never part of a word.
TOKEN_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x2E if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b for b in range(256))
END, BLANK = 0x2E, 0x20
ODD_1, ODD_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def coded_words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """(names, ids): the distinct words, and the texts as ids from 1 on with a 0 behind every piece that has words."""
    raw = np.frombuffer(("\n".join(texts) + "\n").encode().translate(TOKEN_TABLE), np.uint8)
    in_word = (raw != END) & (raw != BLANK)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], in_word, [False]])))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[in_word])]
    ).dictionary_encode()
    piece = np.cumsum(raw == END)[starts]
    ids = np.zeros(len(starts) + (piece[-1] + 1 if len(starts) else 1), np.int64)
    cut = np.cumsum(np.diff(piece, prepend=piece[:1]) > 0)  # ends of pieces before every word
    ids[np.arange(len(starts)) + cut] = np.asarray(words.indices) + 1
    return words.dictionary.cast(pa.large_string()), ids[: len(starts) + (cut[-1] + 1 if len(starts) else 1)]


class FMIndex:
    """Counts of the words before any interval of rows, for rows sorted by their first ``depth`` words.

    ``ids`` are words from 1 on, and 0 where a piece ends; the sequence must end with 0 and is read as a circle.
    Rows alike in these words stand in any order: no interval of up to ``depth`` words depends on it.
    """

    def __init__(self, ids: np.ndarray, depth: int):
        n, width = len(ids), int(ids.max()) + 1
        key, top = ids, width
        for k in range(1, depth):
            if top * width >= 2**62:
                key = np.unique(key, return_inverse=True)[1]
                top = int(key.max()) + 1
            key, top = key * width + np.roll(ids, -k), top * width
        order = np.argsort(key)
        self.n = n
        self.bwt = ids[order - 1]  # the word before each row
        self.first = np.concatenate([[0], np.cumsum(np.bincount(ids))])
        self.keys = np.sort(self.bwt * n + np.arange(n))
        self.ends = np.concatenate([[0], np.cumsum(self.bwt == 0)])

    def rank(self, word: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``word`` stands before the rows ahead of ``row``."""
        return np.searchsorted(self.keys, word * self.n + row) - self.first[word]

    def inside(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How many rows of each interval have a word of their own piece before them."""
        return high - low - self.ends[high] + self.ends[low]


class Grams(NamedTuple):
    """n-grams of one length: their words, counts, and how many occurrences have a word to the left and to the right."""

    words: np.ndarray  # (n-grams, length)
    counts: np.ndarray
    left: np.ndarray
    right: np.ndarray


def ngrams(ids: np.ndarray, longest: int, wanted=None) -> Iterator[Grams]:
    """All n-grams of 1 to ``longest`` words that hold no 0.

    ``wanted`` tells which rows of ``words`` to keep; what it drops is not extended.
    """
    forward, backward = FMIndex(ids, longest), FMIndex(np.append(ids[-2::-1], 0), longest)
    width = len(forward.first)
    words = np.arange(1, width - 1)[:, None]
    low, high = forward.first[1:-1], forward.first[2:]
    back_low, back_high = backward.first[1:-1], backward.first[2:]
    there = high > low
    words, low, high, back_low, back_high = (x[there] for x in (words, low, high, back_low, back_high))
    while True:
        if wanted is not None:
            kept = wanted(words)
            words, low, high, back_low, back_high = (x[kept] for x in (words, low, high, back_low, back_high))
        counts = high - low
        yield Grams(words, counts, forward.inside(low, high), backward.inside(back_low, back_high))
        if words.shape[1] == longest or not len(low):
            return
        # Every (n-gram, word before one of its occurrences) once, in the order of the n-grams.
        parent = np.repeat(np.arange(len(low)), counts)
        rows = np.arange(len(parent)) - np.repeat(np.cumsum(counts) - counts, counts) + low[parent]
        pairs = np.sort(parent * width + forward.bwt[rows])
        new = np.flatnonzero(np.diff(pairs, prepend=-1))
        parent, word = np.divmod(pairs[new], width)
        sizes = np.diff(new, append=len(pairs))
        # Reversed, the n-gram is followed by the word: its rows stand behind those followed by smaller ones.
        done = np.cumsum(sizes) - sizes
        begins = np.searchsorted(parent, np.arange(len(low)))
        back_low = back_low[parent] + done - done[begins[parent]]
        inside = word > 0
        parent, word, back_low, sizes = parent[inside], word[inside], back_low[inside], sizes[inside]
        words = np.column_stack([word, words[parent]])
        low = forward.first[word] + forward.rank(word, low[parent])
        high, back_high = low + sizes, back_low + sizes


def _word_hashes(lang: str, names: pa.Array) -> tuple[np.uint64, np.ndarray]:
    hashes = [xxhash.xxh3_64_intdigest(w) for w in names.to_pylist()]
    return np.uint64(xxhash.xxh3_64_intdigest(lang)), np.array([0, *hashes], np.uint64)


def _hashes(of_lang: np.uint64, of_word: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A 64-bit number for every row of ``words``, the same in all shards."""
    found = np.full(len(words), of_lang, np.uint64)
    for i in range(words.shape[1]):
        found = (found * ODD_1) ^ of_word[words[:, i]]
        found = (found ^ (found >> np.uint64(32))) * ODD_2
    return (found ^ (found >> np.uint64(29))).view(np.int64)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """(lang, names, ids) of every language of every shard."""
    for langs, texts in blocks(batches, SHARD_BYTES):
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(langs.to_pylist(), texts):
            by_lang.setdefault(lang, []).append(text)
        del texts
        for lang in list(by_lang):
            names, ids = coded_words(by_lang.pop(lang))
            if len(names):
                yield lang, names, ids


def _batches(columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    for start in range(0, len(whole), BATCH_ROWS):
        yield whole.slice(start, BATCH_ROWS)


def _source(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(docs[f"`{lang_col}`"].cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"),
    )


def possible_hashes(docs: DataFrame, least: int, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(h): the hashes of all words and pairs that may occur ``least`` times. Those left out occur less often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, names, ids in _shards(batches):
            hashes = _word_hashes(lang, names)
            for found in ngrams(ids, SIEVED):
                enough = np.minimum(found.counts, least).astype(np.int32)  # a shard that reaches the limit alone decides
                yield from _batches({"h": pa.array(_hashes(*hashes, found.words)), "n": pa.array(enough)})

    counted = _source(docs, lang_col, text_col).mapInArrow(run, "h long, n int")
    return counted.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h")


def bitmap(hashes: DataFrame, count: int) -> np.ndarray:
    """The bytes of a bitmap in which the low bits of every hash (h) name a set bit."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (count * BITS_PER_HASH - 1).bit_length()))
    slot = F.col("h").bitwiseAND(F.lit(bits - 1)) + 1  # the functions count from 1, in blocks of 32,768 bits
    placed = hashes.select(F.bitmap_bucket_number(slot).alias("block"), F.bitmap_bit_position(slot).alias("place"))
    # Dealt before they are added up, so no task holds more than its blocks.
    found = placed.repartition("block").groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits")).toArrow()
    whole = np.zeros((bits // LEAST_BITS, LEAST_BITS // 8), np.uint8)
    for block, held in zip(found["block"].to_pylist(), found["bits"].to_pylist()):
        whole[block - 1] = np.frombuffer(held, np.uint8)
    return whole.reshape(-1)


def set_in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes meet a set bit."""
    slot = hashes & (len(bits) * 8 - 1)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def phrase_counts(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = 1,
    lang_col: str = "lang",
    text_col: str = "text",
    few_hashes: int = FEW_HASHES,
) -> DataFrame:
    """(lang, phrase, words, n, with_left, with_right) of the n-grams of 1 to ``longest`` words within pieces.

    Those that occur at least ``least`` times are returned, and for every language a row of 0 words and the
    empty phrase with the number of all its words. ``phrase`` joins its words by blanks. ``with_left`` and
    ``with_right`` count the occurrences that have a word of the same piece before and behind them.
    """
    spark = docs.sparkSession
    shared, exact = None, True
    if least > 1:
        left_over, delete = stage_for_now(possible_hashes(docs, least, lang_col, text_col), "phrase_hashes")
        count = left_over.count()
        exact = count <= few_hashes
        held = np.sort(left_over.toArrow().column("h").to_numpy()) if exact else bitmap(left_over, count)
        shared = spark.sparkContext.broadcast(held)
        delete()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None if shared is None else shared.value

        def columns(lang: str, phrase: pa.Array, length: int, h: np.ndarray, *numbers: np.ndarray) -> dict[str, pa.Array]:
            n = len(phrase)
            named = {"lang": pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int32))), "phrase": phrase.cast(pa.string())}
            counts = dict(zip(("n", "with_left", "with_right"), map(pa.array, numbers)))
            return {**named, "words": pa.array(np.full(n, length, np.int32)), "h": pa.array(h), **counts}

        for lang, names, ids in _shards(batches):
            hashes = _word_hashes(lang, names)

            def wanted(words: np.ndarray) -> np.ndarray:
                h = _hashes(*hashes, words[:, :SIEVED])  # the pairs behind the first one were looked up before
                if not exact:
                    return set_in(kept, h)
                if not len(kept):
                    return np.zeros(len(h), bool)
                return kept[np.minimum(np.searchsorted(kept, h), len(kept) - 1)] == h

            total = np.array([np.count_nonzero(ids)])
            yield from _batches(columns(lang, pa.array([""]), 0, np.zeros(1, np.int64), total, total, total))
            for found in ngrams(ids, longest, None if kept is None else wanted):
                size = found.words.shape[1]
                for at in range(0, len(found.counts), BATCH_ROWS):
                    words, *numbers = (x[at : at + BATCH_ROWS] for x in found)
                    parts = [names.take(pa.array(words[:, i] - 1)) for i in range(size)]
                    phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
                    yield from _batches(columns(lang, phrase, size, _hashes(*hashes, words[:, :SIEVED]), *numbers))

    fields = "lang string, phrase string, words int, h long, n long, with_left long, with_right long"
    found = _source(docs, lang_col, text_col).mapInArrow(run, fields)
    return (
        found.groupBy("lang", "phrase", "words")
        .agg(F.sum("n").alias("n"), F.sum("with_left").alias("with_left"), F.sum("with_right").alias("with_right"))
        .where((F.col("n") >= least) | (F.col("words") == 0))
    )


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    share: int = SHARE,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top`` phrases.

    A phrase of 2 to ``longest`` words that occurs at least ``least`` times (a) is cut in two; the cut of the
    lowest score floor(1,000,000 a^2 / (l r)) counts, the first on a tie. A phrase goes if a longer candidate
    that holds it has at least ``share`` percent of its occurrences. Ranked by score, a, and phrase. The
    candidates of a language are cut to the first ``top`` of every salted part before they meet.
    """
    # A part occurs at least as often as its phrase, so the frequent n-grams hold all parts.
    counted = phrase_counts(docs, longest, least, lang_col, text_col).select("lang", "phrase", "words", "n")
    kept, _ = stage_for_now(counted, "phrases")
    totals = kept.where("words = 0").select("lang", F.col("n").alias("total"))
    frequent = kept.where("words > 0")
    whole = frequent.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    def part(first, size):
        return F.array_join(F.slice("w", first, size), " ")

    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    cuts = whole.select("lang", "phrase", "a", "words", "w", cut.alias("k"))
    count = frequent.select("lang", F.col("phrase").alias("part"), F.col("n").alias("of_part"))
    left = cuts.withColumn("part", part(F.lit(1), F.col("k"))).join(count, ["lang", "part"]).withColumnRenamed("of_part", "l").drop("part")
    both = left.withColumn("part", part(F.col("k") + 1, F.col("words") - F.col("k"))).join(count, ["lang", "part"])
    # Counts up to 10^16 keep the products within 38 digits.
    exact = {c: f"CAST({c} AS DECIMAL(16, 0))" for c in ("a", "l", "r")}
    score = F.expr(f"(1000000 * ({exact['a']} * {exact['a']})) DIV ({exact['l']} * {exact['r']})").cast("long")
    scored = (
        both.withColumnRenamed("of_part", "r")
        .withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    inner = (
        whole.where("words > 2")
        .select("lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
        .select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("first"))
        .select("lang", part(F.col("first"), F.col("size")).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    free = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))
    )
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # A language's first phrases are among the first of its salted parts, so no task sorts a whole language.
    salted = free.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    of_part = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    first = salted.withColumn("place", of_part).where(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(broadcast_if_small(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )


ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT row_number() OVER () AS piece_no, lang, [x FOR x IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF x <> ''] AS w
  FROM pieces
), words AS (
  SELECT piece_no, lang, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM worded
), following AS (
  SELECT lang, word, lead(word) OVER piece AS second, lead(word, 2) OVER piece AS third
  FROM words WINDOW piece AS (PARTITION BY piece_no ORDER BY i)
), grams AS (
  SELECT lang, size, phrase, count(*) AS n FROM (
    SELECT lang, 1 AS size, word AS phrase FROM following
    UNION ALL SELECT lang, 2, word || ' ' || second FROM following WHERE second IS NOT NULL
    UNION ALL SELECT lang, 3, word || ' ' || second || ' ' || third FROM following WHERE third IS NOT NULL)
  GROUP BY ALL
), totals AS (
  SELECT lang, sum(n) AS n FROM grams WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM grams WHERE size > 1 AND n >= 10
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, f.n AS l, s.n AS r,
         (1000000::HUGEINT * c.a::HUGEINT * c.a::HUGEINT) // (f.n::HUGEINT * s.n::HUGEINT) AS score
  FROM candidates c JOIN (SELECT unnest([1, 2]) AS k) ks ON k < c.size
  JOIN grams f ON f.lang = c.lang AND f.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN grams s ON s.lang = c.lang AND s.phrase = array_to_string(c.w[k + 1 : c.size], ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(w[1 : 2], ' ') AS phrase, a FROM candidates WHERE size = 3
    UNION ALL
    SELECT lang, array_to_string(w[2 : 3], ' ') AS phrase, a FROM candidates WHERE size = 3)
  GROUP BY lang, phrase
), ranked AS (
  SELECT l.*, row_number() OVER (PARTITION BY l.lang ORDER BY score DESC, a DESC, l.phrase) AS rank
  FROM lowest l LEFT JOIN inner_phrases i ON i.lang = l.lang AND i.phrase = l.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * a
)
SELECT r.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n::BIGINT AS n, score::BIGINT AS score
FROM ranked r JOIN totals t ON t.lang = r.lang
WHERE rank <= 2000
"""
