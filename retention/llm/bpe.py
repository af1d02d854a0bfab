"""Byte-level BPE encoding and decoding.

Pre-tokenisation needs no regular expression: an array gives every code point its
class, a finite automaton says where a piece starts, and its transition functions
are composed by an associative scan over blocks of the text. The slices between
the boundaries are merged once per distinct piece and looked up from then on.
Every token keeps the byte offset at which it ends, so that any part of a text can
be decoded without decoding what stands before it.

Null texts count as empty. An empty text has no tokens. Repeated rows and ties are
encoded independently, row by row; an empty table gives an empty table. Columns
other than the id and the text are not read. A text of any length is encoded
whole, in memory proportional to its own length.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.merging import merge
from retention.llm.text import blocks, list_array, out_schema, two_columns

# Classes of code points.
LETTER, NUMBER, OTHER, SPACE = range(4)
# What the automaton reads: a class, or what a look at the next characters makes of it. SHORT and LONG are an
# apostrophe before one or two letters of a contraction; JOIN a blank and ALONE another white space before a
# character that is none; RUN white space before more of it or the end; RESET stands between documents.
L, N, O, SHORT, LONG, JOIN, ALONE, RUN, RESET = range(9)
# Its states: at the start of a piece, inside a run, after a blank that joins, inside a contraction.
FRESH, IN_L, IN_N, IN_O, JOINING, IN_RUN, ONE_LEFT, TWO_LEFT = range(8)
CONTRACTIONS_SHORT = "stmd"
CONTRACTIONS_LONG = ("re", "ve", "ll")
BLOCK = 512
KEPT_PIECES = 500_000
LONG_PIECE = 48
MOST_IDS = 8_000_000
BLOCK_BYTES = 1_000_000


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point, by the Unicode version that the public encoder uses."""
    import tiktoken

    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    text = "".join(map(chr, points))
    ranks = {bytes([b]): b for b in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text)
        table[np.frombuffer(bytes(found).decode().encode("utf-32-le"), np.uint32)] = kind
    return table


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """step[state, symbol] and starts[state, symbol] (does a piece start before the symbol)."""
    step, starts = np.zeros((8, 9), np.uint8), np.ones((8, 9), bool)
    step[:, :] = [IN_L, IN_N, IN_O, ONE_LEFT, TWO_LEFT, JOINING, FRESH, IN_RUN, FRESH]
    for state, symbols in ((IN_L, [L]), (IN_N, [N]), (IN_O, [O, SHORT, LONG]), (IN_RUN, [RUN])):
        step[state, symbols], starts[state, symbols] = state, False
    step[JOINING, [O, SHORT, LONG]] = IN_O
    starts[JOINING, [L, N, O, SHORT, LONG]] = False
    step[ONE_LEFT, :RESET], starts[ONE_LEFT, :RESET] = FRESH, False
    step[TWO_LEFT, :RESET], starts[TWO_LEFT, :RESET] = ONE_LEFT, False
    return step, starts


def _closure(step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the transition functions: the functions, their product table, the index of each symbol."""
    known = {tuple(range(8)): 0}
    generators = [tuple(int(x) for x in step[:, s]) for s in range(9)]
    queue = [tuple(range(8))]
    while queue:
        f = queue.pop()
        for g in generators:
            h = tuple(g[x] for x in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    functions = np.array(list(known), np.uint8)
    product = np.array([[known[tuple(int(x) for x in g[f])] for g in functions] for f in functions], np.uint16)
    return functions, product, np.array([known[g] for g in generators], np.uint16)


STEP, STARTS = _automaton()
FUNCTIONS, PRODUCT, SYMBOL_FUNCTION = _closure(STEP)


def symbols(points: np.ndarray, resets: np.ndarray) -> np.ndarray:
    """What the automaton reads at every code point; ``resets`` are the positions between documents."""
    kind = classes()[points]
    out = kind.copy()
    space = kind == SPACE
    space[resets] = True
    before_space = np.ones(len(points), bool)
    before_space[:-1] = space[1:]
    out[space] = RUN
    alone = space & ~before_space
    out[alone] = ALONE
    out[alone & (points == 0x20)] = JOIN
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        one = points[np.minimum(quotes + 1, len(points) - 1)]
        two = points[np.minimum(quotes + 2, len(points) - 1)]
        out[quotes[np.isin(one, [ord(c) for c in CONTRACTIONS_SHORT])]] = SHORT
        for a, b in CONTRACTIONS_LONG:
            out[quotes[(one == ord(a)) & (two == ord(b))]] = LONG
    out[resets] = RESET
    return out


def boundaries(read: np.ndarray) -> np.ndarray:
    """True where a piece starts. Three steps: the function of each block, their scan, the states inside all blocks."""
    n = len(read)
    rows = -(-n // BLOCK)
    padded = np.full(rows * BLOCK, RESET, np.uint8)
    padded[:n] = read
    columns = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    total = SYMBOL_FUNCTION[columns[0]]
    for j in range(1, BLOCK):
        total = PRODUCT[total, SYMBOL_FUNCTION[columns[j]]]
    shift = 1
    while shift < rows:  # inclusive scan by doubling
        total[shift:] = PRODUCT[total[:-shift], total[shift:]]
        shift *= 2
    state = np.empty(rows, np.uint8)
    state[0] = FRESH
    state[1:] = FUNCTIONS[total[:-1], FRESH]
    found = np.empty((BLOCK, rows), bool)
    for j in range(BLOCK):
        found[j] = STARTS[state, columns[j]]
        state = STEP[state, columns[j]]
    return found.T.reshape(-1)[:n]


class Encoder(dict):
    """Piece -> index into the merged pieces; a piece is merged when it is first seen.

    The first ``KEPT_PIECES`` short pieces stay; what comes later is forgotten at the
    next block, so memory is bounded whatever the vocabulary of the corpus.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.size = np.zeros(max(ranks.values()) + 1, np.int32)
        for token, r in ranks.items():
            self.size[r] = len(token)
        self.ids, self.begin, self.count = array("i"), array("q"), array("q")  # of the pieces, one after another
        self.late: list[str] = []

    def __missing__(self, piece: str) -> int:
        raw = piece.encode()
        found = self.ranks.get(raw)
        ids = [found] if found is not None else self.merged(raw) if raw else []
        self[piece] = at = len(self.begin)
        self.begin.append(len(self.ids))
        self.count.append(len(ids))
        self.ids.extend(ids)
        if at >= KEPT_PIECES or len(piece) > LONG_PIECE:
            self.late.append(piece)
        return at

    def merged(self, raw: bytes) -> list[int]:
        ranks = self.ranks
        parts = [raw[i : i + 1] for i in range(len(raw))]
        if len(raw) > LONG_PIECE:
            return [ranks[p] for p in merge(parts, ranks.get)[0]]
        none = len(ranks) + 1_000_000
        get = ranks.get
        order = [get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
        while order:
            best = min(order)
            if best == none:
                break
            i = order.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del order[i]
            if i < len(order):
                order[i] = get(parts[i] + parts[i + 1], none)
            if i:
                order[i - 1] = get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def forget(self) -> None:
        for piece in self.late:
            del self[piece]
        self.late.clear()
        if len(self.ids) > MOST_IDS:
            self.clear()
            del self.ids[:], self.begin[:], self.count[:]
        elif len(self.begin) > 2 * KEPT_PIECES:  # the first pieces are the frequent ones: they keep their places
            del self.ids[self.begin[KEPT_PIECES] :], self.begin[KEPT_PIECES:], self.count[KEPT_PIECES:]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids of all texts in a row, the byte offset at which each token ends in its text, tokens before each text."""
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        resets = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = np.flatnonzero(boundaries(symbols(points, resets)))
        cuts = starts.tolist()
        cuts.append(len(joined))
        pieces = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        ends = np.searchsorted(starts, resets)  # the piece that stands between two documents
        for e in ends.tolist():
            pieces[e] = ""
        at = np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))
        flat, begin = np.array(self.ids, np.int32), np.array(self.begin, np.int64)
        per_piece = np.array(self.count, np.int64)[at]
        before = np.cumsum(per_piece) - per_piece
        ids = flat[np.repeat(begin[at] - before, per_piece) + np.arange(per_piece.sum())]
        offsets = np.concatenate([[0], (before + per_piece)[ends]])
        position = np.concatenate([[0], np.cumsum(self.size[ids], dtype=np.int64)])
        token_ends = position[1:] - np.repeat(position[offsets[:-1]], np.diff(offsets))
        self.forget()
        return ids, token_ends.astype(np.int32), offsets


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def encoded_batches(batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(ranks)
    for keys, texts in blocks(batches, BLOCK_BYTES):
        ids, ends, offsets = encoder.encode(texts)
        yield pa.RecordBatch.from_arrays([keys, list_array(ids, offsets), list_array(ends, offsets)], ["id", "ids", "ends"])


def decoded_batches(batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    tokens = sorted(ranks, key=ranks.get)
    store = np.frombuffer(b"".join(tokens), np.uint8)
    number = np.array([ranks[t] for t in tokens])
    size, begin = np.zeros(number.max() + 1, np.int64), np.zeros(number.max() + 1, np.int64)
    size[number] = [len(t) for t in tokens]
    begin[number] = np.cumsum(size[number]) - size[number]
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            lists, stops = part.column(1), part.column(2)
            ids = np.asarray(lists.flatten())
            ends = np.asarray(stops.flatten()).astype(np.int64)
            counts = np.asarray(lists.value_lengths())
            lengths = size[ids]
            last = np.cumsum(counts) - 1
            bytes_of = np.where(counts > 0, ends[np.maximum(last, 0)] if len(ends) else 0, 0)
            base = np.cumsum(bytes_of) - bytes_of
            where = np.repeat(base, counts) + ends - lengths  # each token's own place
            inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            out = np.empty(int(bytes_of.sum()), np.uint8)
            out[np.repeat(where, lengths) + inside] = store[np.repeat(begin[ids], lengths) + inside]
            raw = out.tobytes()
            values = [raw[b : b + n] for b, n in zip(base.tolist(), bytes_of.tolist())]
            yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(values, pa.binary())], ["id", "ids", "decoded"])


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, ends): the token ids of every whole text and the byte offset at which each token ends."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))  # a vocabulary: its size doesn't grow with the data
    source = two_columns(docs, id_col, text_col)
    out = source.mapInArrow(lambda b: encoded_batches(b, shared.value), out_schema(source, ids="array<int>", ends="array<int>"))
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the bytes that the ids stand for; every token's bytes go where its offset says."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))
    source = encoded.select(encoded[f"`{id_col}`"].alias("id"), "ids", "ends")
    out = source.mapInArrow(lambda b: decoded_batches(b, shared.value), out_schema(source, ids="array<int>", decoded="binary"))
    return out.withColumnRenamed("id", id_col)


def encode_and_decode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``decode`` gives for what ``encode`` gives, by one Python worker per task instead of two."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))
    source = two_columns(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decoded_batches(encoded_batches(batches, shared.value), shared.value)

    return source.mapInArrow(run, out_schema(source, ids="array<int>", decoded="binary")).withColumnRenamed("id", id_col)


def digests(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the number of tokens and the SHA-256 of its ids (joined by commas) and of the decoded bytes."""
    coded = encode_and_decode(docs, ranks_path, id_col, text_col)
    return coded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
