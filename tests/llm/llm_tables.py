"""Small tables with every awkward case, and plain definitions to compare with."""

from __future__ import annotations

import random
import re

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(20_000))
STORY = "the quick brown fox jumps over the lazy dog while seven wizards boil green tea in old kettles near the frozen lake"

EDGE = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "word"),
    (5, "Four words of it"),
    (6, "Ünï çödé 🙂 ▁ \\ <|endoftext|> </s> [INST] ÉÀ É́"),
    (7, LONG),
    (8, STORY),
    (9, STORY),
    (10, STORY.replace("green", "black") + " at night"),
    (11, STORY.upper()),
    (12, "repeated row of a few common words here"),
    (12, "repeated row of a few common words here"),
    (13, "!!! ??? ..."),
    (None, "a text that has no id at all"),
]
CLASHES = (
    "score rank shard slot ids lossless digest n_words log_weight component_id kept text_ _text variant Group host base"
    " bucket hit_id removed again"
).split()
SCHEMA = "doc_id long, text string"
FULL = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def edge(spark):
    """The edge rows with columns whose names operators use themselves."""
    rows = [(i, t, None, "src", None if t is None else len(t), *["x"] * len(CLASHES)) for i, t in EDGE]
    return spark.createDataFrame(rows, FULL)


def empty(spark):
    return spark.createDataFrame([], FULL)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def vocabulary(seed: int, size: int = 400) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abdeilmnorstuéß") for _ in range(rng.randint(2, 9))) for _ in range(size)]


def prose(rng: random.Random, words: list[str], count: int) -> str:
    return " ".join(rng.choice(words) for _ in range(count))


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)
