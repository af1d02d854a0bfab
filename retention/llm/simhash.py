"""SimHash near-duplicates linked through BK-trees.

A fingerprint has bit b set if more than half of the XXH64 hashes of a text's
shingles have it. Fingerprints link at ``radius`` or fewer differing bits; the
classes are the connected components of those links.

Only distinct fingerprints are linked, so copies cost nothing beyond their own row.
Two fingerprints within two bits agree on at least two of their four quarters:
the six pairs of quarters are the shard keys. Every shard is a BK-tree whose children
are keyed by their Hamming distance to the parent, and a search follows only the edges
within the radius. A shard with more members than ``shard_size`` is dealt again by
pairs of quarters of the bits still open; what is then left has 16 open bits, hence
at most 65,536 different members, whatever the data. The trees are built where
their shard is and not broadcast, since all trees together grow with the corpus.

A null text counts as empty. A text without words has fingerprint zero and links like
any other; fewer words than a shingle make one shingle. Repeated rows and ties share
a class. The class id is the smallest id in the class, null if all its ids are null.
An empty table gives an empty table. Columns other than id and text are not read;
``first_of_classes`` returns them untouched, whatever their names. It keeps one row per class:
the one with the least id (rows without an id last), of repeated ids the one with the least hash
of all its columns, of identical rows one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retention.llm.components import components
from retention.llm.text import blocks, out_schema, two_columns
from retention.sources.staging import stage

SHINGLE = 3
RADIUS = 2
SEED = 42
SHARD_SIZE = 256
SALTS = 64
PAIRS = list(combinations(range(4), 2))


def column_majorities(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of ``hashes``, by adding bit-sliced counters.

    Counters of 1, 2, 4 … values are kept as planes of 64 columns, and pairs of them are
    added by full adders, so that 64 columns are counted at once.
    """
    n = len(hashes)
    planes = [hashes]  # planes[k][i]: bit k of counter i, for all 64 columns
    while len(planes[0]) > 1:
        if len(planes[0]) % 2:
            planes = [np.append(p, np.uint64(0)) for p in planes]
        carry = np.zeros(len(planes[0]) // 2, np.uint64)
        summed = []
        for p in planes:
            a, b = p[0::2], p[1::2]
            either = a ^ b
            summed.append(either ^ carry)
            carry = (a & b) | (either & carry)
        planes = [*summed, carry]
    weights = 1 << np.arange(len(planes), dtype=np.int64)
    bits = np.array([int(p[0]) for p in planes], np.uint64)
    columns = ((bits[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int64)
    counts = weights @ columns
    return int(((2 * counts > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text; A-Z count as a-z, words end at ASCII white space."""
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    return column_majorities(np.array([digest(line[a:b], SEED) for a, b in spans], np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of every whole text as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in blocks(batches):
            values = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([keys, pa.array(values)], ["id", "fp"])

    source = two_columns(docs, id_col, text_col)
    return source.mapInArrow(run, out_schema(source, fp="long"))


class Tree:
    """A BK-tree over fingerprints: the child on edge d differs from its parent in d bits."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def search(self, value: int, radius: int) -> list[int]:
        """Places of all members within ``radius``; other edges than d - radius … d + radius can't hold any."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            at = open_nodes.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            edges = self.children[at]
            if len(edges) <= 2 * radius + 1:
                open_nodes += [node for edge, node in edges.items() if d - radius <= edge <= d + radius]
            else:
                open_nodes += [edges[e] for e in range(d - radius, d + radius + 1) if e in edges]
        return found

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        at, new = 0, len(self.values) - 1
        while new:
            d = (self.values[at] ^ value).bit_count()
            nearer = self.children[at].setdefault(d, new)
            if nearer == new:
                return
            at = nearer


def shard_links(members: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect a shard's members as all links within the radius would: at most one fewer than members."""
    tree, root, links = Tree(), list(range(len(members))), []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, value in enumerate(members):
        for j in tree.search(value, radius):
            a, b = top(i), top(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((value, members[j]))
        tree.add(value)
    return links


def _quarter(fp, k: int, width: int):
    return F.shiftrightunsigned(fp, width * k).bitwiseAND(F.lit((1 << width) - 1))


def shard_keys(prints: DataFrame, size: int) -> DataFrame:
    """(key, fp): the shards of every distinct fingerprint, large ones dealt a second time."""
    fp = F.col("fp")
    first = prints.select(
        "fp",
        F.explode(
            F.array(*[
                F.struct(
                    F.lit(i).alias("way"),
                    F.shiftleft(_quarter(fp, a, 16), 16).bitwiseOR(_quarter(fp, b, 16)).alias("value"),
                )
                for i, (a, b) in enumerate(PAIRS)
            ])
        ).alias("s"),
    ).select("fp", "s.way", "s.value")
    counts = first.groupBy("way", "value").agg(F.count("*").alias("members")).filter("members > 1")
    kept = first.join(counts, ["way", "value"])
    small = kept.filter(F.col("members") <= size).select(F.array("way", "value").alias("key"), "fp")
    rest = F.lit(None).cast("long")  # the 32 bits that the first deal left open
    for i, (a, b) in enumerate(PAIRS):
        c, d = (k for k in range(4) if k not in (a, b))
        rest = F.when(F.col("way") == i, F.shiftleft(_quarter(fp, c, 16), 16).bitwiseOR(_quarter(fp, d, 16))).otherwise(rest)
    again = (
        kept.filter(F.col("members") > size)
        .withColumn("rest", rest)
        .select(
            "fp", "way", "value",
            F.explode(
                F.array(*[
                    F.struct(
                        F.lit(i).cast("long").alias("way"),
                        F.shiftleft(_quarter(F.col("rest"), a, 8), 8).bitwiseOR(_quarter(F.col("rest"), b, 8)).alias("value"),
                    )
                    for i, (a, b) in enumerate(PAIRS)
                ])
            ).alias("s"),
        )
        .select(F.array(F.col("way").cast("long"), "value", "s.way", "s.value").alias("key"), "fp")
    )
    return small.unionByName(again)


def links(prints: DataFrame, radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """(a, b): links between distinct fingerprints that join them into the same classes as all links would."""
    if radius > 2:
        raise ValueError("the shard keys are complete up to two differing bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(members):
            found = shard_links(members, radius) if len(members) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array([x[side] for x in found], np.uint64).view(np.int64)) for side in (0, 1)], ["a", "b"]
            )

        last, members = None, []
        for batch in batches:
            keys = batch.column(0).to_pylist()
            values = np.asarray(batch.column(1)).view(np.uint64).tolist()
            for key, value in zip(keys, values):
                if key != last:
                    if len(members) > 1:
                        yield emit(members)
                    last, members = key, []
                members.append(value)
        yield emit(members)

    dealt = shard_keys(prints, shard_size).repartition(F.col("key")).sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text",
    shard_size: int = SHARD_SIZE,
) -> DataFrame:
    """(id, fingerprint, component_id) of every row."""
    rows = stage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    return classes(rows, radius, shard_size).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def first_of_classes(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text",
    shard_size: int = SHARD_SIZE,
) -> DataFrame:
    """One document of every class, with all its columns.

    Of each class only the least (id, hash of the row) travels; whole rows are then picked by
    that pair, and a fingerprint's copies never meet in one task.
    """
    row = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns])
    keyed = docs.select(row.alias("row"), docs[f"`{id_col}`"].alias("id"), F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))
    keyed = keyed.select("row", F.struct(F.col("id").isNull().alias("last"), "id", F.xxhash64(F.to_json("row")).alias("h")).alias("id"), "text")
    rows = stage(fingerprints(keyed, shingle, "id", "text"), "fingerprints")
    named = classes(rows, radius, shard_size)
    chosen = named.filter(F.col("id") == F.col("component")).select("id").distinct()
    picked = keyed.select("row", "id").join(chosen.hint("merge"), "id")
    # The id holds a hash of all columns: rows that share it are repeats, and the join has put them side by side.
    first = picked.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("id"))).filter("n = 1")
    return first.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def classes(rows: DataFrame, radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """(id, fp, component) of rows (id, fp). A frequent fingerprint is salted, so no task gets all its rows."""
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    salted = rows.withColumn("salt", salt)
    parts = salted.groupBy("fp", "salt").agg(F.min("id").alias("least"))
    prints = stage(parts.groupBy("fp").agg(F.min("least").alias("least")), "distinct-fingerprints")
    found = components(links(prints.select("fp"), radius, shard_size))
    linked = prints.join(found, prints["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    roots = linked.groupBy("root").agg(F.min("least").alias("component"))
    named = linked.join(roots, "root").select("fp", "component")
    spread = parts.select("fp", "salt").join(named, "fp")
    return salted.join(spread, ["fp", "salt"]).select("id", "fp", "component")
