"""Small tables with the awkward cases every operator has to take: nulls, empty and long texts, ties, repeats."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_words long, _found string, _group long"


def sentence(seed: int, words: int) -> str:
    chosen = random.Random(seed)
    vocabulary = ["the", "of", "and", "to", "stone", "river", "green", "light", "market", "seven", "él", "Straße", "9lives"]
    return " ".join(chosen.choice(vocabulary) + str(chosen.randrange(40)) for _ in range(words))


def awkward_rows() -> list[tuple]:
    """Rows of (doc_id, text, lang); ids repeat and are null, texts are null, empty, white space or very long."""
    long_text = "\n".join(sentence(i, 12) for i in range(1500))
    base = sentence(1, 80)
    texts = [
        (1, base, "en"),
        (2, base, "en"),
        (3, base.replace("stone", "Stone") + " tail", "en"),
        (4, "", "en"),
        (5, None, None),
        (6, " \t\n  ", "fr"),
        (7, "word", "fr"),
        (8, "two words", None),
        (9, long_text, "en"),
        (10, "A b C d\nA b C d\n\nA b C d\nA b C d", "de"),
        (None, sentence(2, 60), "de"),
        (None, sentence(2, 60), "de"),
        (11, sentence(3, 70), "en"),
        (11, sentence(3, 70), "en"),
        (11, sentence(4, 70), "en"),
        (12, "x\x1cy \x85 z\x00\xa0end <|endoftext|> it's\r\n\tdone  ", "en"),
        (13, "a" * 3000, "en"),
    ]
    return texts


def documents(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """A table with further columns whose names operators use inside."""
    rows = awkward_rows() if rows is None else rows
    return spark.createDataFrame([(*r, "src", 5, "mine", 1) for r in rows], SCHEMA).repartition(3)
