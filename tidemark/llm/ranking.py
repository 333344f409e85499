"""The best documents for every item, by a search through two trees at once.

Items and documents are vectors over terms: an item has the weight of each of its
terms, a document what an occurrence of the term there counts for. A node of
either tree holds the largest coordinate of all it covers, so the product of two
nodes bounds the score of every pair below them. The search goes down both trees
together and leaves out whatever cannot reach the score that the weakest item of
the node needs: the least of those it has, of which there are `top`. That is exact.

Items come in blocks of about `BLOCK_TERMS` terms (an item is never cut), whose
terms every task knows. For each block the documents are read once and keep only
the terms that the block has; documents stay where they are, and a task builds
trees over groups of at most `GROUP_DOCS` of them, those with the same rarest term
side by side. A first search through one document in `SEED_PART` yields scores that
the search through all of them starts from. Tasks pass on at most `top` rows per
item.

Equal scores go by ascending ``doc_id``, null last. Null and empty texts have no
terms, neither as documents nor as items, and are in no result. Repeated rows rank one
after the other, an item that occurs twice has its rows twice. No rows on either
side give no rows; other columns make no difference.
"""

from __future__ import annotations

import math
import re
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import kind_of, small_batches, stored

# In UTF-8 all bytes of other characters are 0x80 and above.
TERMS = re.compile(rb"[0-9a-z\x80-\xff]+").findall
TOP = 10
BLOCK_TERMS = 1 << 18
GROUP_DOCS = 4096
GROUP_TERMS = 1 << 20
FAN_OUT = 16
LEVELS = 3
SEED_PART = 16


def terms_of(text: str | None) -> list[bytes]:
    return TERMS((text or "").encode().lower())


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, and all their terms."""

    documents: int
    terms: int

    def weight(self, holding: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * holding + 1)))

    def impacts(self, size: int, times: np.ndarray) -> np.ndarray:
        """What terms that occur so often count for in a document of `size` terms."""
        longer = 100 - 90 + (90 * size * self.documents) // self.terms
        return (1_000_000_000 * times) // (1000 * times + 8 * longer)


@dataclass(frozen=True)
class Sparse:
    """Rows of sorted (term, value), one after the other."""

    starts: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def merged(self, size: int) -> Sparse:
        """A row for each `size` rows, with the largest value of each term."""
        owner = np.repeat(np.arange(len(self)) // size, np.diff(self.starts))
        order = np.lexsort((self.terms, owner))
        owner, terms, values = owner[order], self.terms[order], self.values[order]
        first = np.flatnonzero(
            np.append(True, (owner[1:] != owner[:-1]) | (terms[1:] != terms[:-1]))[: len(owner)]
        )
        rows = -(-len(self) // size)
        starts = np.searchsorted(owner[first], np.arange(rows + 1))
        most = np.maximum.reduceat(values, first) if len(first) else values
        return Sparse(starts, terms[first], most)

    def taken(self, rows: np.ndarray) -> Sparse:
        sizes = np.diff(self.starts)[rows]
        starts = np.append(0, np.cumsum(sizes))
        at = np.repeat(self.starts[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return Sparse(starts, self.terms[at], self.values[at])


def sparse(rows: list[np.ndarray], values: list[np.ndarray]) -> Sparse:
    nothing = [np.empty(0, np.int64)]
    return Sparse(
        np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int64),
        np.concatenate(rows or nothing).astype(np.int64),
        np.concatenate(values or nothing).astype(np.int64),
    )


class Tree:
    """Levels from the widest nodes to single rows; `fan[i]` nodes of level i + 1 make one."""

    def __init__(self, rows: Sparse, fan_out: int) -> None:
        self.fan_out = fan_out
        self.levels = [rows]
        for _ in range(LEVELS - 1):
            self.levels.insert(0, self.levels[0].merged(fan_out))

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """The nodes of the next level below the given ones."""
        below = (nodes[:, None] * self.fan_out + np.arange(self.fan_out)).ravel()
        return below[below < len(self.levels[level + 1])]


class Items:
    """The items of a block, and the best documents found for each so far.

    `least` is a score that each item's result is known to reach.
    """

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray, least: np.ndarray, top: int):
        # Items with the same rarest term lie side by side.
        leads = [t[np.lexsort((t, -weights[t]))].tolist() for t in terms]
        self.order = sorted(range(len(terms)), key=lambda i: leads[i])
        fan_out = max(2, math.ceil(len(terms) ** (1 / LEVELS)))
        ordered = [terms[i] for i in self.order]
        self.tree = Tree(sparse(ordered, [weights[t] for t in ordered]), fan_out)
        self.best: list[list[tuple]] = [[] for _ in terms]
        self.least = least[self.order]
        self.top = top
        self._dense = np.zeros((FAN_OUT, len(weights)), np.int64)
        self.pairs = 0
        self._needed = [self.least] * LEVELS
        self.raise_needed()

    def raise_needed(self) -> None:
        """The score that a node's weakest item needs, for all nodes."""
        self._needed = [self.least]
        for _ in range(LEVELS - 1):
            finer, step = self._needed[0], self.tree.fan_out
            self._needed.insert(0, np.minimum.reduceat(finer, np.arange(0, len(finer), step)))

    def search(self, documents: Sparse, doc_ids: list) -> None:
        tree = Tree(documents, FAN_OUT)
        tops = np.arange(len(tree.levels[0]))
        for at in range(0, len(tops), FAN_OUT):
            self._descend(tree, 0, tops[at : at + FAN_OUT], None, doc_ids)
        self.raise_needed()

    def _descend(self, tree: Tree, level: int, nodes: np.ndarray, items, doc_ids: list) -> None:
        """Meets the given nodes of the documents' tree with item nodes of the same level."""
        if items is None:
            items = np.arange(len(self.tree.levels[level]))
        rows, asked = tree.levels[level].taken(nodes), self.tree.levels[level].taken(items)
        place = np.repeat(np.arange(len(nodes)), np.diff(rows.starts))
        self._dense[place, rows.terms] = rows.values
        products = self._dense[: len(nodes), asked.terms] * asked.values
        self._dense[place, rows.terms] = 0
        # An item without a weight ends where it starts and sums up to nothing.
        sums = np.concatenate([np.zeros((len(nodes), 1), np.int64), products.cumsum(axis=1)], axis=1)
        bounds = sums[:, asked.starts[1:]] - sums[:, asked.starts[:-1]]
        self.pairs += bounds.size
        reached = (bounds > 0) & (bounds >= self._needed[level][items])
        if level == LEVELS - 1:
            for row, item in zip(*np.nonzero(reached), strict=True):
                self._offer(int(items[item]), int(bounds[row, item]), doc_ids[nodes[row]])
            return
        for row in np.flatnonzero(reached.any(axis=1)):
            below = tree.children(level, nodes[row : row + 1])
            self._descend(
                tree, level + 1, below, self.tree.children(level, items[reached[row]]), doc_ids
            )

    def _offer(self, item: int, score: int, doc_id) -> None:
        best = self.best[item]
        entry = (-score, doc_id is None, doc_id)
        if len(best) == self.top:
            if entry >= best[-1]:
                return
            best.pop()
        insort(best, entry)
        if len(best) == self.top:
            self.least[item] = max(self.least[item], -best[-1][0])

    def found(self) -> Iterator[tuple[int, object, int]]:
        for place, best in enumerate(self.best):
            for score, _, doc_id in best:
                yield self.order[place], doc_id, -score


def counted(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, times``: how many terms, and how often those with a number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sizes, terms, times = [], [], []
            for text in batch.column("text").to_pylist():
                found = terms_of(text)
                known = Counter(map(numbers.get, found))
                known.pop(None, None)
                sizes.append(len(found))
                terms.append(list(known))
                times.append(list(known.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "terms", "times"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind_of(docs, 'doc_id')}, n long, terms array<int>, times array<long>"
    )


def weighted(rows: DataFrame, corpus: Corpus, weights: np.ndarray) -> DataFrame:
    """``doc_id, lead, terms, impacts`` of documents with a term that weighs something.

    The terms are sorted; ``lead`` is the one of most weight.
    """

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1024):
            kept, leads, terms, impacts = [], [], [], []
            for at, (size, some, times) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("n", "terms", "times")), strict=True)
            ):
                some, times = np.array(some, np.int64), np.array(times, np.int64)
                order = np.argsort(some)
                order = order[weights[some[order]] > 0]
                if len(order):
                    some = some[order]
                    kept.append(at)
                    leads.append(int(some[weights[some].argmax()]))
                    terms.append(some)
                    impacts.append(corpus.impacts(size, times[order]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(kept, pa.int32())),
                    pa.array(leads, pa.int32()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(impacts, pa.list_(pa.int32())),
                ],
                ["doc_id", "lead", "terms", "impacts"],
            )

    return rows.mapInArrow(
        weigh,
        f"doc_id {kind_of(rows, 'doc_id')}, lead int, terms array<int>, impacts array<int>",
    )


def searched(
    documents: DataFrame, terms: list[np.ndarray], weights: np.ndarray, least: np.ndarray, top: int
) -> DataFrame:
    """``place, doc_id, score``: of each task the best documents of each item, by its place."""
    kind = documents.select("doc_id").schema["doc_id"].dataType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(terms, weights, least, top)
        ids, rows, values, held, arrow = [], [], [], 0, None
        for batch in small_batches(batches, 1024):
            arrow = batch.schema.field("doc_id").type
            for doc_id, some, impacts in zip(
                batch.column("doc_id").to_pylist(),
                batch.column("terms").to_numpy(zero_copy_only=False),
                batch.column("impacts").to_numpy(zero_copy_only=False),
                strict=True,
            ):
                ids.append(doc_id)
                rows.append(some)
                values.append(impacts)
                held += len(some)
                if len(ids) >= GROUP_DOCS or held >= GROUP_TERMS:
                    items.search(sparse(rows, values), ids)
                    ids, rows, values, held = [], [], [], 0
        if ids:
            items.search(sparse(rows, values), ids)
        if arrow is not None:
            places, found, scores = zip(*items.found(), strict=True) if any(items.best) else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int32()), pa.array(found, arrow), pa.array(scores, pa.int64())],
                ["place", "doc_id", "score"],
            )

    return (
        documents.sortWithinPartitions("lead", "doc_id")
        .select("doc_id", "terms", "impacts")
        .mapInArrow(search, f"place int, doc_id {kind.simpleString()}, score long")
    )


def best_of(found: DataFrame, top: int) -> DataFrame:
    """The rows with ``rank`` up to `top`."""
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked(items: DataFrame, docs: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: of each item the best documents, at most `top`."""
    asked = stored(
        items.select("item_id", "text").mapInArrow(
            _item_terms, f"item_id {kind_of(items, 'item_id')}, terms array<binary>"
        ),
        "items",
    )
    sizes = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-sizes // BLOCK_TERMS))
    block = F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks))
    found = [
        _ranked(asked.where(block == at).where(F.size("terms") > 0), docs, top)
        for at in range(blocks)
    ]
    return reduce(DataFrame.unionByName, found)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        terms = [sorted(set(terms_of(text))) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"]
        )


def _ranked(asked: DataFrame, docs: DataFrame, top: int) -> DataFrame:
    """The result for a block, whose items and terms the driver and every task know."""
    rows = asked.toArrow()
    if not rows.num_rows:
        kinds = f"item_id {kind_of(asked, 'item_id')}, rank int, doc_id {kind_of(docs, 'doc_id')}"
        return docs.sparkSession.createDataFrame([], f"{kinds}, score long")
    every = [term for terms in rows.column("terms").to_pylist() for term in terms]
    numbers = {term: at for at, term in enumerate(dict.fromkeys(every))}
    counts = stored(counted(docs, numbers), "counted")
    totals = counts.agg(
        F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")
    ).first()
    corpus = Corpus(totals.documents, totals.terms)
    holding = (
        counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    ).toArrow()
    weights = np.zeros(len(numbers), np.int64)
    for term, n in zip(*(holding.column(c).to_pylist() for c in ("term", "n")), strict=True):
        weights[term] = corpus.weight(n)
    terms = [
        np.array([t for t in map(numbers.get, some) if weights[t] > 0], np.int64)
        for some in rows.column("terms").to_pylist()
    ]
    documents = stored(weighted(counts, corpus, weights), "weighted")
    least = np.zeros(len(terms), np.int64)
    seeds = documents.where(F.pmod(F.xxhash64("doc_id", "lead"), F.lit(SEED_PART)) == 0)
    seeds = best_of(searched(seeds, terms, weights, least, top), top).where(F.col("rank") == top)
    for row in seeds.select("place", "score").collect():
        least[row.place] = row.score
    best = best_of(searched(documents, terms, weights, least, top), top)
    names = docs.sparkSession.createDataFrame(
        rows.select(["item_id"]).append_column("place", pa.array(range(rows.num_rows), pa.int32()))
    )
    return best.join(F.broadcast(names), "place").select("item_id", "rank", "doc_id", "score")
