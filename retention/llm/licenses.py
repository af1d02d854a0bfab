"""License scan by a positional index of rare tokens.

The templates' words form the licence vocabulary; their document frequencies over the whole
corpus give inverse document frequencies. Every template is indexed by the positions of its
rarest words. A file looks its licence words up in that index: each occurrence says
where the template would start, and a start on which enough of the template's rare
words agree is a candidate, verified by the template's mandatory key phrases, whose
words must stand consecutively in the file.

A phrase by itself is a template whose rare words must all agree, so every place of every
phrase is found, however often a file has it.

A null text counts as empty and has no words and no labels. Repeated rows are scanned row
by row; ties in rarity are broken by the word itself. Empty tables give empty tables; only id
and text are read. A text of any length is scanned whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.text import WORD_TABLE, blocks, out_schema, two_columns

# The phrases whose places are counted, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Fixed values: (label, words of a public licence notice, key phrases that must stand in the file).
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", ("permission is hereby granted", "to deal in the software")),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license", ("apache license",)),
    ("apache-2", "distributed on an as is basis without warranties or conditions of any kind either express or implied",
     ("without warranties or conditions of any kind",)),
    ("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
     "the free software foundation", ("terms of the gnu general public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license", ("gnu affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("permission to use copy modify", "is hereby granted")),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", ("attribution noncommercial",)),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license", ("attribution sharealike",)),
    ("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution 4",)),
    ("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
)
RARE = 6
AGREE = 0.6


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_TABLE).split()


def vocabulary(phrases=PHRASES, templates=TEMPLATES) -> list[bytes]:
    """All words of phrases and templates: as many as these lists hold, whatever the corpus."""
    texts = [t for t, _ in phrases] + [t for _, t, _ in templates] + [k for _, _, keys in templates for k in keys]
    return sorted({w for t in texts for w in t.encode().split()})


def document_frequencies(docs: DataFrame, words: list[bytes], id_col: str, text_col: str) -> tuple[np.ndarray, int]:
    """In how many documents each licence word stands, and the number of documents."""
    known = set(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = Counter(), 0
        for _, texts in blocks(batches):
            for text in texts:
                counts.update(known.intersection(words_of(text)))
                n += 1
        rows = [(w.decode(), c) for w, c in counts.items()] + [("", n)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64())], ["word", "n"])

    summed = two_columns(docs, id_col, text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"].encode(): r["n"] for r in summed.collect()}  # one row per licence word
    return np.array([found.get(w, 0) for w in words], np.int64), found.get(b"", 0)


class Index:
    """Rare words of all templates with their positions."""

    def __init__(self, words: list[bytes], frequency: np.ndarray, n: int, phrases=PHRASES, templates=TEMPLATES, rare: int = RARE):
        self.number = {w: i for i, w in enumerate(words)}
        self.idf = [math.log((n + 1) / (int(f) + 1)) + 1 for f in frequency]
        self.templates = []  # (label, words, mandatory phrases, is a phrase itself)
        self.postings: dict[int, list[tuple[int, int, float]]] = {}
        self.mass = []
        entries = [(label, text, (text,), True) for text, label in phrases] + [(*t, False) for t in templates]
        for t, (label, text, keys, base) in enumerate(entries):
            ids = [self.number[w] for w in text.encode().split()]
            self.templates.append((label, ids, [[self.number[w] for w in k.encode().split()] for k in keys], base))
            chosen = sorted(range(len(ids)), key=lambda i: (-self.idf[ids[i]], ids[i], i))[:rare]
            self.mass.append(sum(self.idf[ids[i]] for i in chosen))
            for i in chosen:
                self.postings.setdefault(ids[i], []).append((t, i, self.idf[ids[i]]))

    def scan(self, words: list[bytes], agree: float = AGREE) -> tuple[list[int], set[str], set[str], float]:
        """Starts of all phrase places, labels of phrases, all labels, score."""
        get = self.number.get
        numbers = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
        places = np.flatnonzero(numbers >= 0)
        votes: dict[tuple[int, int], float] = {}
        for place, number in zip(places.tolist(), numbers[places].tolist()):
            for t, at, weight in self.postings.get(number, ()):
                key = (t, place - at)
                votes[key] = votes.get(key, 0.0) + weight
        starts, base_labels, labels, score = [], set(), set(), 0.0
        for (t, start), weight in votes.items():
            label, ids, keys, base = self.templates[t]
            share = weight / self.mass[t]
            if base:
                if share > 1 - 1e-9 and start >= 0 and numbers[start : start + len(ids)].tolist() == ids:
                    starts.append(start)
                    base_labels.add(label)
                    score = 1.0
            elif share >= agree and all(self.stands(numbers, start, len(ids), k) for k in keys):
                labels.add(label)
                score = max(score, min(1.0, share))
        return starts, base_labels, labels | base_labels, score

    @staticmethod
    def stands(numbers: np.ndarray, start: int, size: int, phrase: list[int]) -> bool:
        """Does the phrase stand where the template would, give or take a few words?"""
        window = numbers[max(0, start - 4) : max(0, start + size + 4)].tolist()
        return any(window[i : i + len(phrase)] == phrase for i in range(len(window) - len(phrase) + 1))


def scan_licenses(
    docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, rare: int = RARE, agree: float = AGREE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_words, starts, base_labels, labels, score): places of phrases and all labels, as arrays."""
    words = vocabulary(phrases, templates)
    frequency, n = document_frequencies(docs, words, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(Index(words, frequency, n, phrases, templates, rare))  # size of the lists above

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for keys, texts in blocks(batches):
            split = [words_of(t) for t in texts]
            found = [index.scan(w, agree) for w in split]
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array([len(w) for w in split], pa.int64()),
                    pa.array([sorted(f[0]) for f in found], pa.list_(pa.int64())),
                    pa.array([sorted(f[1]) for f in found], strings),
                    pa.array([sorted(f[2]) for f in found], strings),
                    pa.array([f[3] for f in found], pa.float64()),
                ],
                ["id", "n_words", "starts", "base_labels", "labels", "score"],
            )

    source = two_columns(docs, id_col, text_col)
    out = source.mapInArrow(
        run, out_schema(source, n_words="long", starts="array<long>", base_labels="array<string>", labels="array<string>", score="double")
    )
    return out.withColumnRenamed("id", id_col)
