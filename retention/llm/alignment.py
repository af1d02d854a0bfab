"""Alignment of the tokens that two tokenizers make of the same text.

Both tokenizers cover the bytes of a blank and the text. Per batch, ``merge_asof`` keyed by document
looks up for every token start the token of the other side that covers it; the union of both
directions gives all overlapping pairs of tokens. Pairs whose ranges end at one byte are links, and
their ends cut the tokens into groups, the smallest stretches that both sides tile with whole tokens.

Of two linked tokens one ends with all bytes of the other. The two vocabularies therefore fix all
pairs of ids that can ever be linked (``Pairs``), whatever the corpus: the corpus-wide counts are one
array of that length. Tasks count into it, the sums are broadcast, and no link is ever shuffled.

A null or empty text has no tokens, and neither has a text that one of the tokenizers doesn't give
back byte for byte (``n_a`` and all other numbers are zero, lists are empty). Repeated rows and rows
of equal or null id are aligned row by row, and each counts. An empty table gives an empty table.
Columns other than the id and the text are not read. A text of any length is aligned whole.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.text import blocks, list_array, out_schema, two_columns
from retention.sources.staging import stage_for_now

BLANK = "▁"
BLOCK_BYTES = 1_000_000
BETWEEN, LAST_A, LAST_B = ",", "|", ";"
LONG_TEXT = 500_000
#: Fixed value: what a byte-level vocabulary's own splitter matches.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The byte behind every character of a byte-level vocabulary: printable ones stand for themselves, the rest follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)) - set(printable))
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranked(a_json: str):
    """The same encoder by ranks, several times faster, if the vocabulary's ids are its merges' order; else None."""
    import tiktoken

    whole = json.loads(a_json)
    model, splitter = whole["model"], whole["pre_tokenizer"] or {}
    plain = splitter.get("type") == "ByteLevel" and not splitter.get("add_prefix_space") and splitter.get("use_regex", True)
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    alphabet, special = byte_alphabet(), {t["content"] for t in whole["added_tokens"]}
    vocabulary = {name: i for name, i in model["vocab"].items() if name not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    in_order = all(vocabulary.get("".join(m)) == 256 + k for k, m in enumerate(merges))
    single = {vocabulary.get(c) for c in alphabet} == set(range(256))
    if model["type"] != "BPE" or not plain or whole["normalizer"] or any(model.get(k) for k in odd) or not in_order or not single:
        return None
    ranks = {bytes(alphabet[c] for c in name): i for name, i in vocabulary.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


class Sides:
    """Both tokenizers, built in the process that uses them, and the bytes of all their tokens."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.fast = ranked(a_json)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet = byte_alphabet()
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            known = all(c in alphabet for c in name)
            self.a_bytes[i] = bytes(alphabet[c] for c in name) if known else name.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace(BLANK, " ").encode()

    def _first(self, text: str) -> list[int]:
        if self.fast is not None and len(text) <= LONG_TEXT:  # the splitter of the fast one has a limit of steps
            return self.fast.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], list[int]]:
        """Ids of both sides for every text, none for a text that one side doesn't give back, and the bytes they cover."""
        a = [self._first(" " + t) for t in texts]
        b = self.b.encode(texts, num_threads=1)
        of_a, of_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        covered = [0] * len(texts)
        for i, text in enumerate(texts):
            whole = b" " + text.encode()
            if not text or b"".join(map(of_a, a[i])) != whole or b"".join(map(of_b, b[i])) != whole:
                a[i], b[i] = [], []
            else:
                covered[i] = len(whole)
        return a, b, covered


class Pairs:
    """All pairs of ids one of which ends with all bytes of the other, numbered in order of (a, b)."""

    def __init__(self, sides: Sides):
        self.width = len(sides.b_bytes)
        keys: set[int] = set()
        of_a, of_b = _by_bytes(sides.a_bytes), _by_bytes(sides.b_bytes)
        for token, ids in of_a.items():
            for b in (b for k in range(len(token)) for b in of_b.get(token[k:], ())):
                keys.update(a * self.width + b for a in ids)
        for token, ids in of_b.items():
            for a in (a for k in range(1, len(token)) for a in of_a.get(token[k:], ())):
                keys.update(a * self.width + b for b in ids)
        self.keys = np.array(sorted(keys), np.int64)
        self.b = self.keys % self.width

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, a * self.width + b)

    def best(self, counts: np.ndarray) -> np.ndarray:
        """Is a pair's count the highest of its b?"""
        highest = np.zeros(self.width, np.int64)
        np.maximum.at(highest, self.b, counts)
        return counts == highest[self.b]


def _by_bytes(tokens: list[bytes]) -> dict[bytes, list[int]]:
    found: dict[bytes, list[int]] = {}
    for i, token in enumerate(tokens):
        if token:
            found.setdefault(token, []).append(i)
    return found


class Side:
    """The tokens of one side for a batch of texts: ids, documents, and byte ranges on one common line."""

    def __init__(self, ids: list[list[int]], size: np.ndarray, base: np.ndarray):
        self.counts = np.array([len(x) for x in ids], np.int64)
        self.before = np.cumsum(self.counts) - self.counts
        self.ids = np.concatenate([np.asarray(x, np.int64) for x in ids]) if ids else np.zeros(0, np.int64)
        self.doc = np.repeat(np.arange(len(ids)), self.counts)
        sizes = size[self.ids]
        ends = np.cumsum(sizes)
        first = np.concatenate([[0], ends])[self.before]
        self.end = ends - first[self.doc] + base[self.doc]
        self.start = self.end - sizes


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Places of all overlapping pairs of tokens, in text order of the later start."""
    left = pd.DataFrame({"at": a.start, "doc": a.doc, "a": np.arange(len(a.ids))})
    right = pd.DataFrame({"at": b.start, "doc": b.doc, "b": np.arange(len(b.ids))})
    covering_b = pd.merge_asof(left, right, on="at", by="doc")
    covering_a = pd.merge_asof(right, left, on="at", by="doc")
    one = covering_b["a"].to_numpy(), covering_b["b"].to_numpy().astype(np.int64)
    other = covering_a["a"].to_numpy().astype(np.int64), covering_a["b"].to_numpy()
    new = a.start[other[0]] != b.start[other[1]]  # tokens that start together stand in both directions
    pairs_a, pairs_b = np.concatenate([one[0], other[0][new]]), np.concatenate([one[1], other[1][new]])
    order = np.argsort(np.maximum(a.start[pairs_a], b.start[pairs_b]), kind="stable")
    return pairs_a[order], pairs_b[order]


class Aligned:
    """A batch of texts: the tokens of both sides, overlaps, links, and the number of the group of every token."""

    def __init__(self, sides: Sides, texts: list[str]):
        a_ids, b_ids, covered = sides.encode(texts)
        length = np.array(covered, np.int64)
        base = np.cumsum(length) - length
        self.a, self.b = Side(a_ids, sides.a_size, base), Side(b_ids, sides.b_size, base)
        self.over_a, self.over_b = overlaps(self.a, self.b)
        equal = self.a.end[self.over_a] == self.b.end[self.over_b]
        self.link_a, self.link_b = self.over_a[equal], self.over_b[equal]  # in text order, one for each group
        self.group_a = np.searchsorted(self.link_a, np.arange(len(self.a.ids)))
        self.group_b = np.searchsorted(self.link_b, np.arange(len(self.b.ids)))
        self.links = np.bincount(self.a.doc[self.link_a], minlength=len(texts))

    def written(self, table: list[str], width_a: int, width_b: int) -> list[str]:
        """Per text its groups as ``a1,a2|b1;a3|b2,b3``. ``table`` is ``id_texts`` of the two vocabularies."""
        n, m = len(self.a.ids), len(self.b.ids)
        last_a, last_b = np.zeros(n, np.int64), np.zeros(m, np.int64)
        last_a[self.link_a], last_b[self.link_b] = 1, 1
        order = np.empty(n + m, np.int64)  # every group's tokens of A, then those of B
        done_a, done_b = self.link_a + 1, np.concatenate([[0], self.link_b + 1])
        order[np.arange(n) + done_b[self.group_a]] = self.a.ids + width_a * last_a
        order[np.arange(m) + done_a[self.group_b]] = 2 * width_a + self.b.ids + width_b * last_b
        entries = order.tolist()
        stops = np.cumsum(self.a.counts + self.b.counts).tolist()
        return ["".join(map(table.__getitem__, entries[lo:hi]))[:-1] for lo, hi in zip([0, *stops], stops)]


def id_texts(width_a: int, width_b: int) -> list[str]:
    a, b = [str(i) for i in range(width_a)], [str(i) for i in range(width_b)]
    return [x + end for side, last in ((a, LAST_A), (b, LAST_B)) for end in (BETWEEN, last) for x in side]


def _read(a_path: str, b_path: str) -> tuple[str, bytes]:
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return a.read(), b.read()


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, a_ids, b_ids, overlap_a, overlap_b, link_a, link_b) of every whole text.

    Overlaps and links are places in the lists of ids, in text order. A group ends with each link.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_read(a_path, b_path))  # vocabularies: their size is fixed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides(*shared.value)
        for keys, texts in blocks(batches, BLOCK_BYTES):
            found = Aligned(sides, texts)
            a, b = found.a, found.b
            over = np.bincount(a.doc[found.over_a], minlength=len(texts))
            lists = [list_array(a.ids, _offsets(a.counts)), list_array(b.ids, _offsets(b.counts))]
            for at_a, at_b, counts in ((found.over_a, found.over_b, over), (found.link_a, found.link_b, found.links)):
                for side, at in ((a, at_a), (b, at_b)):
                    lists.append(list_array((at - side.before[side.doc[at]]).astype(np.int32), _offsets(counts)))
            names = ["id", "a_ids", "b_ids", "overlap_a", "overlap_b", "link_a", "link_b"]
            lists = [x.cast(pa.list_(pa.int32())) for x in lists]
            yield pa.RecordBatch.from_arrays([keys, *lists], names)

    source = two_columns(docs, id_col, text_col)
    lists = {c: "array<int>" for c in ("a_ids", "b_ids", "overlap_a", "overlap_b", "link_a", "link_b")}
    return source.mapInArrow(run, out_schema(source, **lists)).withColumnRenamed("id", id_col)


def alignment_counts(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every whole text.

    A pair's count is the number of links of the whole corpus between its two ids. ``n_best`` counts the
    links whose count is the highest of their B id, ``count_sum`` adds the counts of all links.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    files = _read(a_path, b_path)
    pairs = Pairs(Sides(*files))
    shared, numbered = context.broadcast(files), context.broadcast(pairs)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, known = Sides(*shared.value), numbered.value
        widths = len(sides.a_bytes), len(sides.b_bytes)
        table = id_texts(*widths)
        for keys, texts in blocks(batches, BLOCK_BYTES):
            found = Aligned(sides, texts)
            a, b = found.a, found.b
            digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in found.written(table, *widths)]
            linked = known.number(a.ids[found.link_a], b.ids[found.link_b]).astype(np.int32)
            columns = [pa.array(a.counts), pa.array(b.counts), pa.array(found.links), pa.array(digests, pa.string())]
            columns.append(list_array(linked, _offsets(found.links)))
            yield pa.RecordBatch.from_arrays([keys, *columns], ["id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(numbered.value.keys), np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(batch.column(0).flatten()), minlength=len(total))
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], ["pair", "n"])

    source = two_columns(docs, id_col, text_col)
    fields = {"n_a": "long", "n_b": "long", "n_groups": "long", "groups_sha256": "string", "pairs": "array<int>"}
    linked, _ = stage_for_now(source.mapInArrow(link, out_schema(source, **fields)), "alignment_links")
    summed = linked.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(pairs.keys), np.int64)  # as long as the vocabularies make it, not the corpus
    found = summed.toArrow()  # pairs that the vocabularies allow, no more
    counts[found["pair"].to_numpy()] = found["n"].to_numpy()
    judged = context.broadcast((counts, pairs.best(counts)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_of, is_best = judged.value
        for batch in batches:
            lists = batch.column(5)
            flat = np.asarray(lists.flatten())
            bounds = _offsets(np.asarray(lists.value_lengths()))
            sums = [np.concatenate([[0], np.cumsum(x[flat], dtype=np.int64)]) for x in (is_best, n_of)]
            best, total = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
            kept = [batch.column(i) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [*kept, batch.column(3), pa.array(best), pa.array(total), batch.column(4)],
                ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    fields = {c: "long" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")}
    out = linked.mapInArrow(weigh, out_schema(linked, **fields, groups_sha256="string"))
    return out.withColumnRenamed("id", id_col)
