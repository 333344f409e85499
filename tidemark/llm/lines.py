"""Quality rules: counts over a text, and lines that recur across a host's documents.

Lines are normalised (A-Z in lower case, words joined by one space) and hashed
to 64 bits. A line is boilerplate if more than `min_documents` documents of its host
hold it, and either more than `max_share` percent of them or, for a line of at least
`long_words` words, more than `max_documents`: a sentence that so many pages of a host
repeat is boilerplate however large the host. Boilerplate lines are removed; a
document that keeps less than `min_kept` percent of its words is depleted and rejected.
Exact copies count as one document: to count each would remove all lines of a text
with many copies and reject every copy, where removing copies is another stage's
work, which keeps one of them.

Everything is keyed by (host, digest of the text), as nothing else decides.
A null host is a host of its own; a null text has no words and no lines, and
is not depleted. Rows with equal ids are judged one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import kind_of, small_batches, stored, unused
from tidemark.llm.tokens import words_of

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class LineRules:
    """Limits; shares are in percent."""

    min_words: int = 50
    max_repeat_words: int = 50
    min_documents: int = 10
    max_share: int = 10
    long_words: int = 8
    max_documents: int = 30
    min_kept: int = 50


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds at least twice."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    total, covered = 0, 0
    for at, window in enumerate(windows):
        if found[window] > 1:
            total += at + 3 - max(at, covered)
            covered = at + 3
    return total


def line_words(text: str) -> dict[int, tuple[int, int]]:
    """Hash of each normalised line with a word, its words and those of all its occurrences."""
    found: dict[int, tuple[int, int]] = {}
    for line in text.encode().lower().split(b"\n"):
        words = line.split()
        if words:
            key = line_hash(words)
            found[key] = len(words), found.get(key, (0, 0))[1] + len(words)
    return found


def line_hash(words: list[bytes]) -> int:
    unsigned = xxhash.xxh3_64_intdigest(b" ".join(words))
    return unsigned - (1 << 64) if unsigned >> 63 else unsigned


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = words_of(text)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def host_key(host: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit(""))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("binary"), F.lit(b""))))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
LINES = ["lines", "line_words", "all_words"]


def document_lines(docs: DataFrame) -> DataFrame:
    """Per document its counts, and its lines as ``lines, line_words, all_words``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            counts = list(zip(*map(text_counts, texts), strict=True)) or [()] * len(COUNTS)
            lines = [line_words(text or "") for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([list(x) for x in lines], pa.list_(pa.int64())),
                    *(
                        pa.array([[n[k] for n in x.values()] for x in lines], pa.list_(pa.int32()))
                        for k in (0, 1)
                    ),
                ],
                ["doc_id", "host", "text_key", *COUNTS, *LINES],
            )

    keyed = docs.select(
        "doc_id", host_key(F.col("source")).alias("host"),
        text_key(F.col("text")).alias("text_key"), "text",
    )
    counts = ", ".join(f"{name} long" for name in COUNTS)
    return keyed.mapInArrow(
        count,
        f"doc_id {kind_of(docs, 'doc_id')}, host string, text_key binary, {counts}, "
        "lines array<long>, line_words array<int>, all_words array<int>",
    )


def boilerplate(documents: DataFrame, rules: LineRules) -> DataFrame:
    """``host, text_key, removed`` (hashes) and ``removed_words`` of texts with such lines."""
    lines = documents.select(
        "host", "text_key", F.explode(F.arrays_zip(*LINES)).alias("_line")
    ).select("host", "text_key", F.col("_line.lines").alias("line"), "_line.line_words", "_line.all_words")
    lines = lines.distinct()
    texts = documents.groupBy("host").agg(F.count_distinct("text_key").alias("texts"))
    often = F.col("found") * 100 > F.col("texts") * rules.max_share
    long = (F.col("words") >= rules.long_words) & (F.col("found") > rules.max_documents)
    frequent = (
        lines.groupBy("host", "line")
        .agg(F.count("*").alias("found"), F.max("line_words").alias("words"))
        .where(F.col("found") > rules.min_documents)
        .join(texts, "host")
        .where(often | long)
        .select("host", "line")
    )
    return (
        lines.join(frequent, ["host", "line"])
        .groupBy("host", "text_key")
        .agg(F.collect_list("line").alias("removed"), F.sum("all_words").alias("removed_words"))
    )


def with_verdict(frame: DataFrame, rules: LineRules) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to rows with counts and ``removed_words``."""
    n = F.col("n_words")
    left = n - F.coalesce("removed_words", F.lit(0))
    failed = (n < rules.min_words) | (
        F.col("n_repeat_words") * 100 > n * rules.max_repeat_words
    )
    return frame.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (left * 100 >= n * rules.min_kept)
    )


def judge(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Per document: ``doc_id``, the counts, ``removed_words``, ``base_failed``, ``kept``."""
    documents = stored(document_lines(docs), "document-lines")
    judged = documents.drop(*LINES).join(
        boilerplate(documents, rules).drop("removed"), ["host", "text_key"], "left"
    )
    return with_verdict(judged, rules).select(
        "doc_id", *COUNTS, F.coalesce("removed_words", F.lit(0)).alias("removed_words"),
        "base_failed", "kept",
    )


def cleaned(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The kept documents without their boilerplate lines, in the columns of `docs`.

    ``n_chars`` follows the text where lines went. A null text is never kept.
    """
    documents = stored(document_lines(docs), "document-lines")
    verdict = (
        with_verdict(
            documents.join(boilerplate(documents, rules), ["host", "text_key"], "left"), rules
        )
        .where("kept")
        .groupBy("host", "text_key")
        .agg(F.first("removed").alias("removed"))
    )
    names = docs.columns
    host, key, removed = unused(names, "host", "text_key", "removed")
    keyed = docs.withColumns(
        {host: host_key(F.col("source")), key: text_key(F.col("text"))}
    )
    kept = keyed.join(verdict.toDF(host, key, removed), [host, key]).select(*names, removed)
    text, size = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    schema = ", ".join(f"`{n}` {kind_of(docs, n)}" for n in names)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            columns = batch.columns[:-1]
            texts = columns[text].to_pylist()
            drops = batch.column(len(names)).to_pylist()
            texts = [without(t, set(d)) if d else t for t, d in zip(texts, drops, strict=True)]
            columns[text] = pa.array(texts, columns[text].type)
            if size is not None:
                columns[size] = pa.array(
                    [
                        len(t) if d else n
                        for t, d, n in zip(texts, drops, columns[size].to_pylist(), strict=True)
                    ],
                    columns[size].type,
                )
            yield pa.RecordBatch.from_arrays(columns, names)

    return kept.mapInArrow(strip, schema)


def without(text: str, removed: set[int]) -> str:
    """The text without the lines whose normalised form has one of the hashes."""
    left = []
    for line in text.split("\n"):
        words = line.encode().lower().split()
        if not words or line_hash(words) not in removed:
            left.append(line)
    return "\n".join(left)
