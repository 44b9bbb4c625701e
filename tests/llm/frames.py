"""Small tables with every awkward case, and brute-force versions that share no code with the operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = ("score", "node", "row", "spans", "label", "path", "hits", "_id", "value", "key", "term", "kept")


def documents(spark, rows):
    """(doc_id, text) rows as a table that has columns named like those the operators make."""
    # Spread, so that tasks and not the planner work on the rows.
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return frame.withColumns({name: F.lit("x") for name in CLASHING})


def prose(rng: random.Random, words: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary):04d}" for _ in range(words))


def awkward(rng: random.Random):
    """Null id and text, empty and blank texts, a very long one, repeated rows and a repeated id."""
    same = prose(rng, 60)
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, same), (6, same), (6, same),
        (7, prose(rng, 60)), (7, prose(rng, 60)), (None, same), (None, prose(rng, 40)),
        (8, prose(rng, 60_000)), (9, "é" * 40 + " Ünï 😀"), (10, "x" * 300_000),
    ]


def splits(pattern: str, text: str | None) -> list[str]:
    return re.findall(pattern, (text or "").translate(LOWER))
