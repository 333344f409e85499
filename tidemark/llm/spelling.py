"""Spelling variants: words that differ by one letter, from a bit-sliced position index.

The index of a set of words holds, per position and letter, the words with that
letter there as bits of one number. A word is looked up letter by letter, with
one operation on whole numbers for all words at once: the words that agree so
far, and those that agree but for one letter replaced, inserted or deleted, the
last two by the slices of the next and the previous position.

Two words of which the shorter has m letters and that are one letter apart share
their first or last floor(m/2) letters. So words are dealt by both into blocks,
each with an index of its own. Blocks of more than `CELL_WORDS` words are dealt
into parts, of which any two meet in a cell, so no task's index outgrows that.

A word's form is the word next to it with the most occurrences, if it has at
least `times` as many; forms lead to the root. Texts are whole; a null or empty
text, or one without letters, has no words; a null id counts as the empty one.
Repeated rows count each time, ties go to the smallest word in code-point order,
other columns make no difference, and no rows give no words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import small_batches, stored

RUNS = re.compile("[a-zÀ-ÿ]+").findall
MIN_LETTERS = 6
MIN_COUNT = 5
TIMES = 5
# One of so many words per document loses a letter.
MISSPELT = 199
COUNTED_ROWS = 200_000
CELL_WORDS = 4096


def runs_of(doc_id: object, text: str | None, misspelt: int = MISSPELT) -> Iterator[tuple[str, int]]:
    """The words of a document and how often each occurs, some without one letter."""
    found = Counter(RUNS((text or "").encode().lower().decode()))
    seed = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, times in found.items():
        drawn = crc32(word.encode(), seed)
        if drawn % misspelt == 0:
            at = drawn % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, times


def word_counts(
    docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT
) -> DataFrame:
    """``word, n`` of the words with enough letters and occurrences in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for batch in small_batches(batches):
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for word, times in runs_of(doc_id, text):
                    if len(word) >= min_letters:
                        total[word] = total.get(word, 0) + times
            if len(total) >= COUNTED_ROWS:
                yield _counted(total)
                total = {}
        yield _counted(total)

    return (
        docs.select(F.col("doc_id").cast("string"), "text")
        .mapInArrow(count, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= min_count)
    )


def _counted(total: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(total, pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"]
    )


class PositionIndex:
    """The words, of which bit k stands for the k-th, sliced by position and letter."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self._all = (1 << len(words)) - 1
        self._slices: dict[tuple[int, str], int] = {}
        self._sized: dict[int, int] = {}
        slices, sized = self._slices, self._sized
        for k, word in enumerate(words):
            bit = 1 << k
            sized[len(word)] = sized.get(len(word), 0) | bit
            for place in enumerate(word):
                slices[place] = slices.get(place, 0) | bit

    def near(self, word: str, half: int, tail: bool) -> int:
        """The words one letter apart of which the shorter has a half of so many letters.

        With `tail`, only those that do not share the first `half` letters.
        """
        slices = self._slices.get
        exact = inserted = self._all
        replaced = deleted = 0
        head = 0
        for at, letter in enumerate(word):
            here = slices((at, letter), 0)
            if at == half:
                head = exact
            replaced = replaced & here | exact & ~here
            deleted = deleted & slices((at - 1, letter), 0) | exact
            exact &= here
            inserted = inserted & slices((at + 1, letter), 0) | exact
        size, sized = len(word), self._sized.get
        found = 0
        if size // 2 == half:
            found = replaced & sized(size, 0) | inserted & sized(size + 1, 0)
        if (size - 1) // 2 == half:
            found |= deleted & sized(size - 1, 0)
        return found & ~head if tail else found


def neighbours(words: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """``word, n_near, best, best_n`` of the words that have a word one letter apart.

    `words` has distinct ``word`` of at least `min_letters` letters, and ``n``.
    """
    size = F.length("word")
    halves = F.array(F.floor(size / 2).cast("int"), F.floor((size - 1) / 2).cast("int"))
    halved = words.withColumn("half", F.explode(F.array_distinct(halves))).where(
        F.col("half") >= min_letters // 2
    )
    dealt = halved.select(
        "word", "n", "half",
        F.explode(F.array(F.lit(False), F.lit(True))).alias("tail"),
    ).withColumn("share", F.expr("if(tail, right(word, half), left(word, half))"))
    block = ["tail", "share"]
    parts = (
        dealt.groupBy(*block)
        .agg(F.count("*").alias("rows"))
        .where("rows > 1")
        .select(*block, F.ceil(F.col("rows") / CELL_WORDS).cast("int").alias("parts"))
    )
    cell = [*block, "i", "j"]
    cells = (
        dealt.join(parts, block)
        .withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
        .select(*cell, "part", "half", "word", "n")
        .repartition(*cell)
        .sortWithinPartitions(*cell, F.desc("n"), "word")
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tail, _, i, j), rows in _groups(batches, len(cell)):
            half = rows[0][1]
            one = [(word, n) for part, _, word, n in rows if part == i]
            two = one if i == j else [(word, n) for part, _, word, n in rows if part == j]
            sides = [(one, two)] if i == j else [(one, two), (two, one)]
            for asked, known in sides:
                index = PositionIndex([word for word, _ in known])
                found = []
                for word, _ in asked:
                    if near := index.near(word, half, tail):
                        # The words are in order, so the lowest bit is the best.
                        best, most = known[(near & -near).bit_length() - 1]
                        found.append((word, near.bit_count(), best, most))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(out.names, row, strict=True)) for row in found], schema=out
                )

    out = pa.schema(
        [("word", pa.string()), ("n_near", pa.int64()), ("best", pa.string()), ("most", pa.int64())]
    )
    first = F.min(F.struct((-F.col("most")).alias("less"), "best")).alias("first")
    return (
        cells.mapInArrow(look, "word string, n_near long, best string, most long")
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), first)
        .select("word", "n_near", "first.best", (-F.col("first.less")).alias("best_n"))
    )


def _groups(
    batches: Iterable[pa.RecordBatch], keys: int
) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of equal keys, which lie side by side; the keys are the first columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every ``word`` with a ``form``: the last one that forms lead to.

    Each round doubles the steps taken; as a form occurs several times as often as
    its word, a few rounds suffice.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = reached.toDF("root", "next")
        if reached.join(onward, "root", "left_semi").isEmpty():
            return reached
        reached = stored(
            reached.join(onward, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root")
            ),
            "forms",
        )


def variants(docs: DataFrame, times: int = TIMES) -> DataFrame:
    """Per word: ``word, n, n_near, form, form_n, root``."""
    words = stored(word_counts(docs), "words")
    wide = F.col("best_n") >= times * F.col("n")
    formed = stored(
        words.join(neighbours(words), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(wide, F.col("best")).alias("form"),
            F.when(wide, F.col("best_n")).alias("form_n"),
        ),
        "formed",
    )
    last = roots(formed.where("form is not null"))
    return formed.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
