"""Document fingerprints as Merkle trees over paragraphs and sections.

A paragraph is a line of the text. Its leaves are short checksums of runs of up to
`RUN` words from its start; its hash covers its exact bytes. Paragraphs whose hash is divisible
by `SECTION`, and blank lines, end a section, so an edit moves no border but its
own. A section's hash covers its paragraphs' hashes, the root's covers the
sections' hashes. Equal texts have equal roots, and texts that differ have
different roots but for collisions of 128 bits.

A fingerprint is a text: the root, then for every section its hash and its
paragraphs, each with its hash, its number of words and its leaves. Comparing
two goes down only into branches whose hashes differ.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b, sha256
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import kind_of

RUN = 4
SECTION = 8
RANGE_ROWS = 5_000
ROOT_BYTES, NODE_BYTES = 16, 8
LEAF_DIGITS = 6


def digest(data: bytes, size: int) -> bytes:
    return blake2b(data, digest_size=size).digest()


def fingerprint(text: str) -> str:
    """``root;section:paragraph.words.leaves,paragraph...;section:...`` in hexadecimal."""
    sections, paragraphs, hashes = [], [], []
    section_hashes = []

    def close() -> None:
        section = digest(b"".join(hashes), NODE_BYTES)
        section_hashes.append(section)
        sections.append(f"{section.hex()}:{','.join(paragraphs)}")
        paragraphs.clear()
        hashes.clear()

    for line in text.encode().split(b"\n"):
        words = line.split()
        own = digest(line, NODE_BYTES)
        leaves = [
            "%06x" % (crc32(b" ".join(words[i : i + RUN])) & 0xFFFFFF)
            for i in range(0, len(words), RUN)
        ]
        hashes.append(own)
        paragraphs.append(f"{own.hex()}.{len(words)}.{''.join(leaves)}")
        if not words or own[0] % SECTION == 0:
            close()
    if hashes:
        close()
    root = digest(b"".join(section_hashes), ROOT_BYTES)
    return ";".join([root.hex(), *sections])


@dataclass(frozen=True)
class Paragraph:
    number: int
    hash: str
    words: int
    leaves: tuple[str, ...]


def tree(printed: str) -> tuple[str, list[tuple[str, list[Paragraph]]]]:
    root, *rest = printed.split(";")
    sections, number = [], 0
    for part in rest:
        name, _, listed = part.partition(":")
        paragraphs = []
        for item in listed.split(","):
            own, words, leaves = item.split(".")
            starts = range(0, len(leaves), LEAF_DIGITS)
            runs = tuple(leaves[i : i + LEAF_DIGITS] for i in starts)
            paragraphs.append(Paragraph(number, own, int(words), runs))
            number += 1
        sections.append((name, paragraphs))
    return root, sections


def differing(one: str, two: str) -> tuple[list[Paragraph], list[Paragraph]]:
    """The paragraphs of either text in branches without an equal one in the other."""
    (root_one, first), (root_two, second) = tree(one), tree(two)
    if root_one == root_two:
        return [], []
    first, second = _unmatched(first, second, lambda s: s[0])
    return _unmatched(
        [p for _, listed in first for p in listed],
        [p for _, listed in second for p in listed],
        lambda p: p.hash,
    )


def _unmatched(one: list, two: list, key) -> tuple[list, list]:
    shared = Counter(map(key, one)) & Counter(map(key, two))
    kept = []
    for side in (one, two):
        left, open_nodes = Counter(shared), []
        for node in side:
            if left[key(node)]:
                left[key(node)] -= 1
            else:
                open_nodes.append(node)
        kept.append(open_nodes)
    return kept[0], kept[1]


def likeness(one: str, two: str) -> float:
    """Twice the words in matching branches and leaves, by the words of both texts.

    1 for equal roots. Texts without a word are alike only if they are equal.
    """
    if one.partition(";")[0] == two.partition(";")[0]:
        return 1.0
    words = [sum(p.words for _, listed in tree(x)[1] for p in listed) for x in (one, two)]
    if not sum(words):
        return 0.0
    first, second = differing(one, two)
    matched = sum(words) - sum(p.words for p in first) - sum(p.words for p in second)
    runs = [
        Counter(
            (leaf, min(RUN, p.words - RUN * i)) for p in side for i, leaf in enumerate(p.leaves)
        )
        for side in (first, second)
    ]
    matched += 2 * sum(size * n for (_, size), n in (runs[0] & runs[1]).items())
    # Different roots are different texts, even if only white space differs.
    return min(matched / sum(words), 1 - 1e-9)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


OUTPUT = [
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
OUTPUT_SQL = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compared(text: str, own: str, following: str, other: str) -> tuple:
    changed = edited(text, following)
    printed = own if changed == text else fingerprint(changed)
    return (
        len(text), sha256(changed.encode()).hexdigest(), own, printed,
        likeness(own, printed), likeness(own, other),
    )


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Per document its fingerprint, and those of its edited text and its successor.

    Successors go by descending ``doc_id``; after the last comes the first. Null
    texts are empty; null ids come last, rows with equal ids in the order of
    their texts. A single document is its own successor, no document gives no row.

    The ids alone are first cut into ranges of about `range_rows`; of each, the first
    id goes to all tasks, 8 bytes for so many documents. A task then reads one range in
    order and holds two documents at a time. The document after a range is the first
    of the next one, so documents with a range's first id also go to the end of the
    range before.
    """
    kind = kind_of(docs, "doc_id")
    firsts = _first_ids(docs, range_rows)
    known = np.array([i for i in firsts if i is not None], np.int64)[::-1]

    # The range of an id, and 1 more if it is the range's first: twice the one plus the other.
    @F.pandas_udf("long")
    def placed(ids: pd.Series) -> pd.Series:
        found = ids.fillna(np.iinfo(np.int64).min).to_numpy()
        if not len(known):
            return pd.Series(np.ones(len(found), np.int64))
        at = len(known) - 1 - np.searchsorted(known, found, side="left")
        at = np.clip(at, 0, len(known) - 1)
        first = (known[::-1][at] == found) & ids.notna().to_numpy()
        return pd.Series(2 * at + first)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            rows = []
            for part, is_next, doc_id, text in zip(
                *(batch.column(n).to_pylist() for n in ("part", "is_next", "doc_id", "text")),
                strict=True,
            ):
                text = text or ""
                printed = fingerprint(text)
                if before is not None and before[0] == part:
                    rows.append((before[1], *compared(*before[2:], text, printed)))
                before = None if is_next else (part, doc_id, text, printed)
            columns = list(zip(*rows, strict=True)) or [()] * (1 + len(OUTPUT))
            kinds = [batch.column("doc_id").type, *(t for _, t in OUTPUT)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["doc_id", *(n for n, _ in OUTPUT)],
            )

    # Nulls, whatever their type, are after all ids.
    ids = docs.select("doc_id", "text", placed(F.col("doc_id").cast("long")).alias("place"))
    ranges = max(len(firsts), 1)
    part = F.shiftright("place", 1).cast("int")
    own = F.struct(part.alias("part"), F.lit(False).alias("is_next"))
    copy = F.struct(
        F.pmod(part + F.lit(ranges - 1), F.lit(ranges)).alias("part"), F.lit(True).alias("is_next")
    )
    places = F.when(F.col("place") % 2 == 1, F.array(own, copy)).otherwise(F.array(own))
    return (
        ids.select(F.explode(places).alias("place"), "doc_id", "text")
        .select("place.part", "place.is_next", "doc_id", "text")
        .repartitionById(ranges, "part")
        .sortWithinPartitions("part", "is_next", F.desc_nulls_last("doc_id"), F.asc("text"))
        .mapInArrow(read, f"doc_id {kind}, {OUTPUT_SQL}")
    )


def _first_ids(docs: DataFrame, range_rows: int) -> list[int | None]:
    """The first id of every range, descending: one in some thousand ids."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((batch for batch in batches if batch.num_rows), None)
        for _ in batches:
            pass
        if first is not None:
            yield first.slice(0, 1)

    ids = docs.select(F.col("doc_id").cast("long").alias("id"))
    ranges = max(1, docs.count() // range_rows)
    order = F.desc_nulls_last("id")
    found = (
        ids.repartitionByRange(ranges, order).sortWithinPartitions(order).mapInArrow(ends, "id long")
    )
    numbers = [row["id"] for row in found.collect()]
    some = sorted({i for i in numbers if i is not None}, reverse=True)
    # Ranges begin with an id; nulls end the last one and are a range only without ids.
    return some or numbers[:1]
