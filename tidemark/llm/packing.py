"""Best-fit packing of documents into sequences of a fixed number of tokens.

Each document goes where the sum, over all residual gaps, of the squared number
of open sequences with that gap becomes smallest (sum-of-squares packing). That
keeps gaps of many sizes open, so that later documents find one that they fill.

Only lengths decide, so only lengths and what a caller wants to keep beside
them are shuffled. Pieces are dealt by hash into groups of about `GROUP_ROWS`
documents; a group holds thousands of sequences and wastes a handful, and its
size does not grow with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import kind_of, small_batches, unused
from tidemark.llm.tokens import ID_BYTES, ID_TYPE, WordEncoder, packed, word_encoder

GROUP_ROWS = 16_384


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, keep_words: bool = True
) -> DataFrame:
    """One row per document, or per piece of `capacity` tokens of a longer one.

    Columns: ``doc_id``, ``piece`` (from 0), ``start`` (ids of the document before
    the piece), ``length`` and ``ids`` (little-endian unsigned 32-bit). Every
    document ends with `end_id`; a null or empty text is that id alone. A null
    or repeated ``doc_id`` is a document of its own. Python workers keep the words they
    have met for their next tasks; without `keep_words` each task gives them up at its
    end, for jobs whose other steps need that memory.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        try:
            yield from pieces(encoder, batches)
        finally:
            if not keep_words:
                encoder.forget()
                pa.default_memory_pool().release_unused()

    def pieces(
        encoder: WordEncoder, batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        end = packed([end_id])
        step = capacity * ID_BYTES
        for batch in small_batches(batches):
            rows = []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = encoder.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((row, piece, at // ID_BYTES, len(part) // ID_BYTES, part))
            row, piece, start, length, ids = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int32())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind_of(docs, 'doc_id')}, piece int, start long, length long, ids binary"
    )


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each size, placed in the order given.

    With N(g) open bins of gap g, placing size s into gap g changes the sum of
    the squares by 2 (N(g-s) - N(g) + 1), or by 1 - 2 N(g) if it fills the bin.
    A new bin is opened if none has room. Equal changes go to the smaller gap.
    """
    count = np.zeros(capacity + 1, np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(sizes), np.int64)
    offsets = np.empty(len(sizes), np.int64)
    made = 0
    for i, size in enumerate(sizes.tolist()):
        gaps = np.flatnonzero(count[size:capacity])
        if len(gaps):
            change = 2 * (count[gaps] - count[gaps + size] + 1)
            if gaps[0] == 0:
                change[0] = 1 - 2 * count[size]
            rest = int(gaps[change.argmin()])
            gap = rest + size
            count[gap] -= 1
            bins[i], offsets[i] = waiting[gap].pop(), capacity - gap
        else:
            rest = capacity - size
            bins[i], offsets[i] = made, 0
            made += 1
        if rest:
            count[rest] += 1
            waiting[rest].append(int(bins[i]))
    return bins, offsets


def groups_for(docs: DataFrame, group_rows: int = GROUP_ROWS) -> int:
    return max(1, -(-docs.count() // group_rows))


def place(pieces: DataFrame, capacity: int, groups: int) -> DataFrame:
    """The rows with ``sequence_id`` and ``offset``: where each piece lies.

    `pieces` has a ``length`` of 1 to `capacity` and any other columns, which are
    kept. Within a group the longest pieces are placed first and ties in the
    order of all columns, so a repeated task places them alike. Offsets of a
    sequence are gapless from 0. No rows give no rows.
    """
    names = pieces.columns
    (number,) = unused(names, "group")
    keyed = pieces.withColumn(number, F.pmod(F.xxhash64(*names), F.lit(groups)))
    kept = ", ".join(f"`{n}` {kind_of(pieces, n)}" for n in names)

    def fill(key: tuple, group: pa.Table) -> pa.Table:
        order = [("length", "descending"), *((n, "ascending") for n in names if n != "length")]
        group = group.select(names).sort_by(order)
        bins, offsets = sum_of_squares(group["length"].to_numpy(), capacity)
        numbers = pa.array(bins * groups + key[0].as_py())
        group = group.append_column("sequence_id", numbers)
        return group.append_column("offset", pa.array(offsets))

    return keyed.groupBy(number).applyInArrow(
        fill, f"{kept}, sequence_id long, offset long"
    )


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``ids`` (array of ints) and ``n_pieces``.

    `placed` is the result of `place` over rows that kept their ``ids``. A
    sequence gathers at most as many ids as its capacity.
    """

    def joined(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(group.sort_values("offset")["ids"]), ID_TYPE)
        return pd.DataFrame(
            {"sequence_id": [key[0]], "ids": [ids.astype(np.int64)], "n_pieces": [len(group)]}
        )

    return (
        placed.select("sequence_id", "offset", "ids")
        .groupBy("sequence_id")
        .applyInPandas(joined, "sequence_id long, ids array<long>, n_pieces int")
    )
