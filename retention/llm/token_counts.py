"""Token counts by heap-and-linked-list byte-pair merging, without making any identifier.

The count of a text is its initial symbols minus the merges made. A symbol is a
character, or one byte of a character that the vocabulary lacks. A blank counts as
U+2581, and the text starts with one. No vocabulary entry has U+2581 after another
character, so no merge crosses from a word to the blank behind it: words are merged
one by one, and a word's count is kept for the next time.

Null texts count as empty and have 0 tokens. Rows are independent: repeated rows
and ties get equal counts, an empty table gives an empty table, other columns are
not read. A word of any length takes O(n log n).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from retention.llm.merging import merge
from retention.llm.text import blocks, out_schema, two_columns

BLANK = "▁"
KEPT_WORDS = 500_000
LONG_WORD = 48
LIMIT = 4096


def read_pieces(path: str) -> dict[str, float]:
    """Pieces that merging may make, each with its order: the negated score, lowest first."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    reserved = ("is_unknown", "is_control", "is_byte", "is_unused")
    pieces = {
        model.id_to_piece(i): -model.get_score(i)
        for i in range(model.get_piece_size())
        if not any(getattr(model, r)(i) for r in reserved)
    }
    if any(BLANK in p[1:] and p.strip(BLANK) for p in pieces):
        raise ValueError("this vocabulary joins words across blanks")
    return pieces


class Counter(dict):
    """Word (with the blanks before it, but for one) -> number of tokens."""

    def __init__(self, pieces: dict[str, float]):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, word: str) -> int:
        parts = list(BLANK + word)
        symbols = sum(1 if p in self.pieces else len(p.encode()) for p in parts)
        n = symbols - merge(parts, self.pieces.get)[1]
        if len(self) < KEPT_WORDS and len(word) <= LONG_WORD:
            self[word] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(BLANK, " ").split(" ")
        if "" in words:  # blanks in a row stand before one word
            joined, blanks = [], 0
            for i, word in enumerate(words):
                if word or i + 1 == len(words):
                    joined.append(BLANK * blanks + word)
                    blanks = 0
                else:
                    blanks += 1
            words = joined
        return sum(map(self.__getitem__, words))


def token_counts(
    docs: DataFrame, model_path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(read_pieces(model_path))  # a vocabulary of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for keys, texts in blocks(batches):
            n = np.fromiter(map(counter.count, texts), np.int64, len(texts))
            size = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(size), pa.array(n), pa.array(n > limit)], ["id", "n_bytes", "n_tokens", "over_limit"]
            )

    source = two_columns(docs, id_col, text_col)
    out = source.mapInArrow(run, out_schema(source, n_bytes="long", n_tokens="long", over_limit="boolean"))
    return out.withColumnRenamed("id", id_col)
