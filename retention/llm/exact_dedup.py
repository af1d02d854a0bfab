"""Exact duplicates by content-defined chunk recipes, in SQL functions only.

A text is lower-cased (A-Z only) and cut into chunks where its own content says so:
after a full stop or line break that follows ``least`` characters, or after ``most``
characters where none comes. Equal texts have equal chunks, and an edit changes only the
chunks around it. Each text is read once and travels as its recipe: per chunk a 64-bit
key and the SHA-256 digest that verifies it.

The chunk table then gets one identifier per verified chunk: the key and, should
different chunks ever share a key, the rank of the digest among them. Texts are equal when
their ordered identifier lists are equal. Of equal texts the row with the largest id stays.

A null text counts as empty and equals empty texts. Of repeated rows (same id, same text)
one stays. Rows without an id lose to rows with one; if no row of a group has an id, one of
them stays. An empty table gives an empty table; other columns are not read. Groups of any
size are pre-aggregated and salted, so no task holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.text import lower_ascii, two_columns
from retention.sources.staging import stage

LEAST, MOST = 1024, 8192
SALTS = 64


def chunk_pattern(least: int = LEAST, most: int = MOST) -> str:
    return rf"(?s).{{{least},{most}}}?[.\n]|.{{1,{most}}}"


def recipes(docs: DataFrame, id_col: str, text_col: str, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(id, text_sha256, recipe, copies): distinct rows with their chunks' keys and digests, in order."""
    rows = two_columns(docs, id_col, text_col).select("id", lower_ascii(F.col("text")).alias("text"))
    chunks = F.regexp_extract_all("text", F.lit(chunk_pattern(least, most)), F.lit(0))
    cut = rows.select("id", F.sha2("text", 256).alias("text_sha256"), chunks.alias("chunks"))
    listed = cut.select(
        "id", "text_sha256",
        F.transform("chunks", lambda c: F.struct(F.xxhash64(c).alias("key"), F.unhex(F.sha2(c, 256)).alias("digest"))).alias("recipe"),
    )
    return listed.groupBy("id", "text_sha256", "recipe").agg(F.count("*").alias("copies"))


def identifiers(chunks: DataFrame) -> DataFrame:
    """(key, digest, salt, rank) of the chunk rows (key, digest, salt): one verified identifier per distinct chunk."""
    dealt = chunks.select("key", "digest", "salt").distinct()
    ranked = (
        dealt.select("key", "digest").distinct()
        .groupBy("key").agg(F.sort_array(F.collect_set("digest")).alias("digests"))
        .select("key", F.posexplode("digests").alias("rank", "digest"))
    )
    return dealt.join(ranked, ["key", "digest"])


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, most: int = MOST
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row."""
    rows = stage(recipes(docs, id_col, text_col, least, most), "recipes").withColumn(
        "salt", F.pmod(F.xxhash64("id", "text_sha256"), F.lit(SALTS))
    )
    chunks = rows.select("id", "text_sha256", "salt", F.posexplode("recipe").alias("at", "chunk")).select(
        "id", "text_sha256", "salt", "at", "chunk.key", "chunk.digest"
    )
    verified = (
        chunks.join(identifiers(chunks), ["key", "digest", "salt"])
        .groupBy("id", "text_sha256", "salt")
        .agg(F.array_sort(F.collect_list(F.struct("at", "key", "rank"))).alias("list"))
    )
    empty = F.array().cast("array<struct<at:int,key:bigint,rank:int>>")
    listed = rows.select(F.col("id").alias("i"), F.col("text_sha256").alias("s"), "copies", "salt").join(
        verified.drop("salt"), F.col("i").eqNullSafe(F.col("id")) & (F.col("s") == F.col("text_sha256")), "left"
    ).select(F.col("i").alias("id"), F.col("s").alias("text_sha256"), "copies", "salt", F.coalesce("list", empty).alias("list"))
    listed = stage(listed, "identifier-lists")
    parts = listed.groupBy("list", "salt").agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    groups = parts.groupBy("list").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    spread = parts.select("list", "salt").join(groups, "list")
    # Equal texts have one digest; rows of one group without any id would all claim to stay, so the first digest row does.
    return (
        listed.join(spread, ["list", "salt"])
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
        .select(
            F.col("id").alias(id_col),
            "keep_id",
            "group_size",
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )


ORACLE = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""
