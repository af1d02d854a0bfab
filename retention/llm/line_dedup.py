"""Cross-site line dedup: lines that many sites share are boilerplate.

How many distinct sites have a line is a HyperLogLog sketch per line key, merged by
aggregation, so a line in every document costs one small sketch per task. Lines whose
estimate is nearer to the threshold than the sketch is exact get exact distinct counts.
Lines on ``sites`` sites or more leave every document except the one with the least id
that has them, so that no text vanishes from the corpus.

Only line keys are joined. A document meets the set of its own boilerplate keys, and its
text is filtered in place with built-in array functions.

Lines are what stands between line breaks, compared as they are; lines of blanks only are
never boilerplate. A null text stays null and has no lines. A null site counts as no site.
A row without an id loses its boilerplate lines unless no row with the line has an id.
Repeated rows are treated alike. Empty tables stay empty. ``remove_lines`` keeps all
columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retention.sources.staging import stage

SITES = 10
LG_K = 12


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """Two independent hashes: 96 bits stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def boilerplate(docs: DataFrame, sites: int, lg_k: int, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """(a, b, least): the keys of boilerplate lines and the least id that has each."""
    text = docs[f"`{text_col}`"].cast("string")
    lines = docs.select(
        docs[f"`{id_col}`"].alias("id"), docs[f"`{site_col}`"].cast("string").alias("site"), F.explode(_lines(text)).alias("line")
    ).filter(F.trim("line") != "")
    keyed = lines.select("id", "site", _key(F.col("line")).alias("k")).select("id", "site", "k.a", "k.b")
    spread = keyed.groupBy("a", "b").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"), F.min("id").alias("least"))
    error = 3 * 1.04 / 2 ** (lg_k / 2)
    estimated = spread.select("a", "b", "least", F.hll_sketch_estimate("sketch").alias("estimate")).filter(
        F.col("estimate") >= sites * (1 - error) - 1
    )
    estimated = stage(estimated, "widespread-lines")
    above = F.col("estimate") > sites * (1 + error) + 1
    near = estimated.filter(~above)
    exact = (
        keyed.join(near.select("a", "b"), ["a", "b"], "left_semi")
        .filter(F.col("site").isNotNull())
        .groupBy("a", "b", "site").agg(F.lit(1).alias("one"))
        .groupBy("a", "b").agg(F.count("*").alias("n"))
        .filter(F.col("n") >= sites)
    )
    return estimated.filter(above).select("a", "b", "least").unionByName(near.join(exact, ["a", "b"]).select("a", "b", "least"))


def remove_lines(
    docs: DataFrame, sites: int = SITES, lg_k: int = LG_K, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
    counts: bool = False,
) -> DataFrame:
    """``docs`` without boilerplate lines; ``counts`` returns (id, n_lines, n_removed, text) instead of all columns."""
    found = stage(boilerplate(docs, sites, lg_k, id_col, text_col, site_col), "boilerplate")
    text = docs[f"`{text_col}`"].cast("string")
    own = docs.select(docs[f"`{id_col}`"].alias("id"), F.explode(_lines(text)).alias("line")).select("id", _key(F.col("line")).alias("k"))
    dropped = (
        own.select("id", "k.a", "k.b")
        .join(found, ["a", "b"])
        .filter(~F.col("id").eqNullSafe(F.col("least")))
        .groupBy("id", "a", "b").agg(F.lit(1).alias("one"))
        .groupBy("id").agg(F.collect_list("a").alias("keys"))  # within one row 64 bits are enough
        .withColumnRenamed("id", "key_id")
    )
    row = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("id"))
    met = row.join(stage(dropped, "dropped-lines").hint("merge"), F.col("id").getField(id_col).eqNullSafe(F.col("key_id")), "left")
    old = _lines(F.col("id").getField(text_col).cast("string"))
    kept = F.filter(old, lambda line: ~F.array_contains(F.col("keys"), F.xxhash64(line)) | (F.trim(line) == ""))
    new = F.when(F.col("keys").isNull(), F.col("id").getField(text_col)).otherwise(F.array_join(kept, "\n"))
    if counts:
        n = F.coalesce(F.size(old).cast("long"), F.lit(0).cast("long"))
        n = F.when(F.col("id").getField(text_col).isNull(), F.lit(0).cast("long")).otherwise(n)
        removed = F.when(F.col("keys").isNull() | F.col("id").getField(text_col).isNull(), F.lit(0)).otherwise(F.size(old) - F.size(kept)).cast("long")
        return met.select(F.col("id").getField(id_col).alias(id_col), n.alias("n_lines"), removed.alias("n_removed"), new.alias("text"))
    changed = met.select(F.col("id"), new.alias("new"))
    return changed.select(*[F.col("new").alias(c) if c == text_col else F.col("id").getField(c).alias(c) for c in docs.columns])


ORACLE = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
), b AS (
  SELECT line, min(doc_id) AS least FROM l WHERE trim(line) <> '' GROUP BY line HAVING count(DISTINCT source) >= {SITES}
), j AS (
  SELECT l.doc_id, l.line, l.pos, b.line IS NOT NULL AND l.doc_id <> b.least AS gone FROM l LEFT JOIN b ON l.line = b.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
FROM j GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
