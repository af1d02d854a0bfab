"""A table of odd rows that every operator must take, and its plain rows."""

import random

SCHEMA = "doc_id long, text string, source string, id string, h long, row string, key int, `a.b` string, n_tokens long"


def odd_texts(seed: int = 1) -> list:
    rnd = random.Random(seed)
    words = ["the", "The", "don't", "we'll", "é", "日本", "a@b.cd", "10.0.0.1", "+1 (234) 555-0199", "4111 1111 1111 1111", "x" * 40, "\t", "\n", "  ", "MIT", "license"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 40))) for _ in range(30)]
    return [*texts, None, "", " ", "\n", "a" * 5000, "one two three " * 3000, "under the MIT license, CC BY-NC", "\x00\x1c  z"]


def odd_rows(seed: int = 1) -> list[tuple]:
    rows = [(i, t, f"s{i % 3}" if i % 5 else None, "id", 7, "row", None, "dot", 3) for i, t in enumerate(odd_texts(seed))]
    again = rows[2]
    return [*rows, again, again, (None, "no id here", None, None, None, None, None, None, None), (None, None, "s1", None, None, None, None, None, None), (3, "same id, other text", "s2", None, None, None, None, None, None)]


def odd_table(spark, seed: int = 1):
    return spark.createDataFrame(odd_rows(seed), SCHEMA).repartition(5)
