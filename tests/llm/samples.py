"""Small document tables for the tests of the training-data operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ta re mi lo shu ner vak dol pim est oru cha wen fli gos".split()


def prose(seed: int, words: int, line: int = 12) -> str:
    """Made-up prose, a line feed after every `line` words."""
    pick = random.Random(seed)
    made = ["".join(pick.choices(SYLLABLES, k=pick.randint(1, 4))) for _ in range(words)]
    return "\n".join(
        " ".join(made[i : i + line]).capitalize() + "." for i in range(0, words, line)
    )


def row(doc_id, text, lang="en", source="src1"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def odd_rows() -> list[tuple]:
    """Nulls everywhere, empty and long texts, repeated rows, equal ids, odd characters."""
    long_text = prose(1, 12_000)
    return [
        row(1, prose(2, 120)),
        row(1, prose(2, 120)),
        row(2, prose(2, 120)),
        row(2, prose(3, 90), None, None),
        row(3, None, None, None),
        row(4, ""),
        row(5, " \t\n\x0b\x0c\r "),
        row(None, prose(4, 80)),
        row(None, prose(4, 80)),
        row(None, None, None, None),
        row(6, long_text),
        row(7, long_text.replace("ta", "ta ", 3)),
        row(8, "word"),
        row(9, "Word"),
        row(10, "naïve café 日本語 \U0001f600 <|endoftext|> it's İ́ a b c"),
        row(11, "same same same same " * 40),
        row(2**60 + 1, prose(5, 70), "", ""),
    ]


# What operators and stages call their own columns.
EXTRA = [
    "ids", "length", "node", "leaf", "key", "piece", "host", "lines", "epoch", "quality",
    "_host", "_text_key", "_removed", "_id", "_key", "_words", "_domain", "_leaf", "_epochs", "_last",
    "_times", "_epoch", "_group", "group", "text_key", "removed", "own_id", "own_key", "domain",
    "words", "epochs", "last", "times", "label", "signature", "score", "x", "part", "place",
    "sequence_id", "offset", "start", "hash", "shard", "page", "n_words", "kept", "n", "tree",
    "terms", "lead", "word", "decoded", "load",
]


def with_extra(docs):
    """The documents with columns of the names that operators use inside."""
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit(n).alias(n) for n in EXTRA))


def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def folder(spark, path, **tables) -> str:
    for name, frame in tables.items():
        frame.write.parquet(f"{path}/{name}.parquet")
    return str(path)
