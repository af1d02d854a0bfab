"""Personal data by weak supervision, in SQL functions only.

Patterns cut every text into gaps and matches; running lengths over both give each match its
place in code points. A match that passes its kind's check is a base span and always
stays. All matches, also those of wider patterns and those that fail the check, are candidates
on which five labelers vote: the strict pattern, a gazetteer (domains, networks, issuers,
country codes), words in the text before, the characters at both edges, and the form.

Votes are aggregated to one row per vote pattern, as many as the labelers allow whatever the
corpus. Expectation-maximisation on that table estimates how reliable each labeler is and how
likely each pattern is personal data; a logistic span classifier is trained on those
likelihoods and, as a column expression, judges every candidate that is no base span. What it
accepts and no base span overlaps is added.

A null text counts as empty and has no spans. Repeated rows get equal results. A table without
any candidate has no added spans; an empty table gives an empty table. Only id and text are
read. Possessive patterns keep long runs of digits or letters linear.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retention.llm.text import two_columns
from retention.sources.staging import stage

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LOCAL = "[A-Za-z0-9._%+-]"
DOMAIN = "[A-Za-z0-9-]"
# (kind, pattern, a cheap test that a text may have it, is it the base pattern). A base pattern equals the plain one of
# its kind: a run can only start where it begins or where the match before it ended.
PATTERNS = (
    (EMAIL, rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{DOMAIN}++(?:\.{DOMAIN}++)++", "@", True),
    (IP, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ".", True),
    (CARD, r"[0-9](?:[\x20-]?[0-9])++", "", True),
    (PHONE, r"\+[0-9][\x20().0-9-]+[0-9]", "+", True),
    (EMAIL, rf"(?<!{LOCAL}){LOCAL}++ ?(?:\(at\)|\[at\]) ?{DOMAIN}++(?: ?(?:\.|\(dot\)|\[dot\]) ?{DOMAIN}++)++", "at", False),
    (PHONE, r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])", "", False),
)
# The gazetteers.
DOMAINS = "com|org|net|edu|gov|io|info|de|fr|es|uk|it|nl|ch|at|be|eu|us|ca|au|jp|in|br|mx"
ISSUERS = "4|5[1-5]|2[2-7]|3[0-9]|60|62|65|64"
COUNTRIES = "1|7|2[07]|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
SPECIAL_NETWORKS = "0|10|127|2[2-5][0-9]"
BEFORE = {
    EMAIL: "mail|contact|write to|reach|address",
    IP: r"\bip\b|address|host|server|login|from",
    CARD: "card|visa|master|amex|payment|credit|debit",
    PHONE: "phone|call|tel|mobile|fax|cell|dial|contact",
}
AGAINST = r"version|release|section|chapter|figure|isbn|issn|order|invoice|serial|id[: ]|\bv\.?$|\bno\.?$|#$|http"
CONTEXT = 40
ROUNDS = 50
ACCEPT = 0.5
VOTES = ("strict", "gazetteer", "context", "edges", "form")
TRAITS = ("size", "parted")


def _yes(test: Column) -> Column:
    """1 for yes, -1 for no, 0 for not known."""
    return F.when(test, 1).when(~test, -1).otherwise(0)


def _cutter(way: int):
    def cut(x: Column, i: Column) -> Column:
        left = F.lower(F.right(x["g"], F.lit(CONTEXT)))
        return F.struct(
            F.lit(way).alias("way"), i.alias("at"), F.length(x["g"]).alias("gap"), x["m"].alias("m"),
            left.alias("left"), F.substring(x["g"], 1, 1).alias("first"),
        )

    return cut


def matches(rows: DataFrame) -> DataFrame:
    """(id, h, way, m, start, left, first) of all matches in rows (id, text); ``way`` counts the patterns."""
    text = F.col("text")
    listed = []
    for way, (_, pattern, needed, _) in enumerate(PATTERNS):
        zipped = F.arrays_zip(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
        cut = F.transform(zipped, _cutter(way))
        test = text.contains(needed) if needed else text.rlike("[0-9]")
        listed.append(F.when(test, cut))
    some = F.flatten(F.filter(F.array(*listed), lambda x: x.isNotNull()))
    cuts = rows.select("id", F.xxhash64("text").alias("h"), F.explode(some).alias("s")).select("id", "h", "s.*")
    cuts = cuts.filter((F.col("at") > 0) | F.col("m").isNotNull())
    order = Window.partitionBy("id", "h", "way").orderBy("at")
    end = F.sum(F.col("gap") + F.coalesce(F.length("m"), F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = cuts.repartition("id", "h", "way").distinct().select(
        "id", "h", "way", "m", "left", (end - F.length("m")).alias("start"), end.alias("end"), F.lead("first").over(order).alias("next")
    )
    return placed.filter(F.col("m").isNotNull())


def candidates(rows: DataFrame) -> DataFrame:
    """(id, h, kind, start, end, base, votes…, traits…): every span on which the labelers vote."""
    found = matches(rows)
    way, m, left = F.col("way"), F.col("m"), F.col("left")
    kind = F.element_at(F.array(*[F.lit(p[0]) for p in PATTERNS]), way + 1)
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    parts = F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    luhn = F.call_function("luhn_check", digits)
    valid = (
        F.when(way == EMAIL, True).when(way == IP, parts).when(way == CARD, n.between(12, 19) & luhn).when(way == PHONE, n.between(9, 15))
    )
    base = F.coalesce(valid, F.lit(False))

    def by_kind(*columns):
        out = F.lit(0)
        for k, c in enumerate(columns):
            out = F.when(F.col("kind") == k, c).otherwise(out)
        return out

    rows = found.withColumn("kind", kind).withColumn("base", base).withColumn("n", n)
    enough = F.when(F.col("kind") == CARD, n.between(12, 19)).when(F.col("kind") == PHONE, n >= 7).otherwise(True)
    rows = rows.filter(F.col("base") | enough)
    lower = F.lower(m)
    before = F.lit(False)
    for k, words in BEFORE.items():
        before = F.when(F.col("kind") == k, left.rlike(words)).otherwise(before)
    glued = F.coalesce(left.rlike(r"[\p{L}0-9_@.+-]$"), F.lit(False)) | F.coalesce(F.col("next").rlike(r"[\p{L}0-9_@]"), F.lit(False))
    uniform = m.rlike(r"^[0-9]+$|^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$|^[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}$")
    return rows.select(
        "id", "h", "kind", "start", "end", "base",
        F.when(way >= len(KINDS), 0).otherwise(_yes(F.col("base"))).alias("strict"),
        by_kind(
            _yes(lower.rlike(rf"[.)\]] ?(?:{DOMAINS})$")),
            _yes(~m.rlike(rf"^(?:{SPECIAL_NETWORKS})\.")),
            _yes(digits.rlike(f"^(?:{ISSUERS})")),
            F.when(way == PHONE, _yes(digits.rlike(f"^(?:{COUNTRIES})"))).otherwise(0),
        ).alias("gazetteer"),
        F.when(left.rlike(AGAINST), -1).when(before, 1).otherwise(0).alias("context"),
        _yes(~glued).alias("edges"),
        by_kind(
            _yes(lower.rlike(r"^[a-z0-9][a-z0-9._%+-]+[ @(\[]") & (F.length(m) <= 254)),
            _yes(~m.rlike(r"(?:^|\.)0[0-9]") & (F.length(m) >= 7)),
            _yes(n.between(13, 16) & uniform),
            _yes(n.between(10, 13)),
        ).alias("form"),
        F.least(F.lit(3), F.floor(F.length(m) / 8)).cast("int").alias("size"),
        m.rlike("[ ()-]").cast("int").alias("parted"),
    )


def reliabilities(table: list) -> list[float]:
    """EM over vote patterns: the likelihood of personal data for each row (kind, votes…, traits…, count) of ``table``.

    Two classes; each labeler that does not abstain votes independently given the class, with its own
    rates of yes and no; each kind has its own share. Starts from the sum of the votes, the strict pattern's twice.
    """
    votes = np.array([[r[v] for v in VOTES] for r in table], int)
    kinds = np.array([r["kind"] for r in table], int)
    weight = np.array([r["count"] for r in table], float)
    p = 1 / (1 + np.exp(-(votes.sum(axis=1) + votes[:, 0]).astype(float)))
    for _ in range(ROUNDS):
        score = np.zeros(len(table))
        for k in range(len(KINDS)):
            at = kinds == k
            yes = (weight * p)[at].sum() + 1
            no = (weight * (1 - p))[at].sum() + 1
            score[at] += math.log(yes / no)
        for j in range(len(VOTES)):
            rate = np.array([[(weight * q)[votes[:, j] == v].sum() + 1 for v in (-1, 1)] for q in (1 - p, p)])
            rate /= rate.sum(axis=1, keepdims=True)
            gain = np.log(rate[1] / rate[0])
            score += np.array([gain[0], 0.0, gain[1]])[votes[:, j] + 1]
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return p.tolist()


def _inputs() -> list[tuple[str, int]]:
    """The classifier's 0/1 inputs: (column, value). The strict pattern taught it and is no input, so it can go beyond it."""
    return [
        *[("kind", k) for k in range(len(KINDS))],
        *[(v, x) for v in VOTES[1:] for x in (-1, 1)],
        *[("size", s) for s in range(1, 4)],
        ("parted", 1),
    ]


def classifier(table: list, target: list[float]) -> list[float]:
    """Weights of a logistic regression on the inputs by Newton's method; the table has one row per pattern."""
    x = np.array([[float(r[c] == v) for c, v in _inputs()] for r in table])
    y, weight = np.array(target), np.array([r["count"] for r in table], float)
    w = np.zeros(x.shape[1])
    ridge = 1e-3 * weight.sum() / len(w) + 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(curvature, gradient)
    return w.tolist()


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): arrays of (start, kind, end) of the base spans and of all spans, in order, of every document."""
    rows = two_columns(docs, id_col, text_col)
    found = stage(candidates(rows), "span-candidates")
    features = ["kind", *VOTES, *TRAITS]
    table = sorted(found.groupBy(*features).count().collect())  # at most one row per vote and trait pattern
    accepted = F.col("base")
    if table:
        weights = classifier(table, reliabilities(table))
        margin = F.lit(0.0)
        for (c, v), w in zip(_inputs(), weights):
            margin += F.when(F.col(c) == v, w).otherwise(0.0)
        # What the strict check refuses must also be named by the text before it.
        accepted = accepted | ((margin >= math.log(ACCEPT / (1 - ACCEPT))) & ((F.col("strict") >= 0) | (F.col("context") > 0)))
    order = Window.partitionBy("id", "h").orderBy("start", "base", "kind", "end")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    spans = (
        found.select("id", "h", "kind", "start", "end", "base", accepted.alias("accepted"))
        .select("*", free.alias("free"))
        .filter(F.col("base") | (F.col("accepted") & F.col("free")))
        .groupBy("id", "h").agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end", "base"))).alias("spans"))
        .withColumnsRenamed({"id": "i", "h": "g"})
    )
    keyed = rows.select("id", F.xxhash64("text").alias("h"))
    met = keyed.join(spans, F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("g")), "left")
    return met.select(F.col("id").alias(id_col), F.filter("spans", lambda s: s["base"]).alias("base"), F.col("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined; empty for none."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    return F.coalesce(F.array_join(one, ","), F.lit(""))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the counts of base spans by kind, the SHA-256 of the base spans, and all spans."""
    found = personal_data(docs, id_col, text_col)

    def count(kind: int) -> Column:
        return F.coalesce(F.size(F.filter("base", lambda s: s["kind"] == kind)), F.lit(0)).cast("long")

    return found.select(
        id_col,
        *[F.when(F.col("base").isNull(), F.lit(0).cast("long")).otherwise(count(k)).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
