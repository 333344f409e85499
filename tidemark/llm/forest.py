"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set holds the hashes of its shingles. Documents with equal sets
are one class; the rest of the work is on one row per class:

1. A signature of `VALUES` minima, a byte of each kept.
2. `ORDERS` trees: each sorts signatures by the values in an order of its own. Neighbours with the longest common prefix lie side by side, so looking
   at the next `WINDOW` rows that share at least `LEAST_DEPTH` values takes in
   whole regions where signatures are sparse, and in dense ones compares at
   the depth at which about a window of rows is left.
3. Neighbours whose signatures agree well enough are candidates; candidates are
   confirmed on the full sets of both texts. A first look takes in only the
   `NEAREST` neighbours, and each class is confirmed with two of those. That
   joins groups of thousands without comparing them pair by pair. The second
   look is at the ends of all candidates, in trees over longer signatures, and
   takes in whole windows, but only neighbours that are still apart. With what
   the first look left untried, these are confirmed: first the best candidate
   between any two components, then all that remain.
4. Where four shared values leave more than a window of others, the class is
   full, and more depth in the signatures would not part its neighbours. Pairs of
   two full classes are left to the order of their shingles: from the rarest
   on, two sets of that similarity share one of the first fifth (`firsts`), and how
   far down it lies in either bounds what they can share (`sharing`). Counts are
   exact and over all full classes, so what no other class has, which in a region
   of variants is most of it, costs nothing. First come the pairs with the class
   of most links of each component, then of any two components the likeliest pair
   at each shingle, and last, when few are still apart, all others.
5. Components of the confirmed links; every turn only adds links between components.

Every candidate is confirmed, refuted, or has ends that confirmed links join. A
pair at a similarity of exactly 0.8 shares the first four values of an order
with probability 0.41, so the chance that no tree brings it together is about
3e-6, and else it is in the window or both ends are full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.lines import text_key
from tidemark.llm.shared import kind_of, small_batches, stored
from tidemark.llm.tokens import lower_words_of

VALUES = 256
ORDERS = 24
WINDOW = 12
NEAREST = 2
LEAST_DEPTH = 2
FULL_DEPTH = 4
SIMILAR = 80  # percent
# Values of the first and second look, and how many of them must agree: both about
# four and a half standard deviations below what is expected at that similarity.
FIRST_VALUES, FIRST_AGREEING = 96, 59
SECOND_VALUES, SECOND_AGREEING = VALUES, 176
# The values that go with a shingle, to choose by, and the pairs they are compared for at once.
SHORT_VALUES, PAIRS_AT_ONCE = 64, 1 << 16
# Classes with one shingle beyond which its pairs are made by several tasks.
CELL_ROWS = 2048
# Pairs whose texts are compared, and classes whose shingles are ordered, by one task.
PAIRS_A_TASK, SETS_A_TASK = 512, 512

MIX = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(20240131)
FACTORS = _RANDOM.integers(0, 1 << 31, VALUES, np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _RANDOM.integers(0, 1 << 32, VALUES, np.uint32)
TREES = {
    values: [_RANDOM.permutation(values) for _ in range(ORDERS)]
    for values in (FIRST_VALUES, SECOND_VALUES)
}


class ShingleSets:
    """Sorted distinct shingle hashes of texts; remembers the hashes of words."""

    def __init__(self, words: int, keep: int = 200_000) -> None:
        self._size = words
        self._keep = keep
        self._known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        """A text with fewer words is one shingle; one without words has none."""
        words = lower_words_of(text)
        known = self._known
        if len(known) > self._keep:
            known.clear()
        get, hashed = known.get, []
        for word in words:
            value = get(word)
            if value is None:
                value = known[word] = xxhash.xxh3_64_intdigest(word)
            hashed.append(value)
        ids = np.array(hashed, np.uint64)
        size = min(self._size, len(ids))
        if not size:
            return ids
        many = len(ids) - size + 1
        rolled = np.full(many, size, np.uint64)
        for at in range(size):
            rolled = (rolled ^ (rolled >> np.uint64(29))) * MIX + ids[at : at + many]
        rolled = (rolled ^ (rolled >> np.uint64(32))) * MIX
        return np.unique(rolled)


def signature(sets: list[np.ndarray]) -> np.ndarray:
    """A row of `VALUES` bytes for each of the sets, none of which is empty."""
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    least = np.empty((VALUES, len(sets)), np.uint32)
    for k in range(VALUES):
        least[k] = np.minimum.reduceat(values * FACTORS[k] + SHIFTS[k], starts)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).T


def signed(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, node`` (the class) and ``signature``.

    A text without words has no class and no signature.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = ShingleSets(words)
        for batch in small_batches(batches):
            sets = [shingles(text) for text in batch.column("text").to_pylist()]
            full = [s for s in sets if len(s)]
            rows = iter(signature(full)) if full else iter(())
            nodes = [
                np.uint64(xxhash.xxh3_64_intdigest(s)).astype(np.int64) if len(s) else None
                for s in sets
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(
                        [next(rows).tobytes() if len(s) else None for s in sets], pa.binary()
                    ),
                ],
                ["doc_id", "text_key", "n_shingles", "node", "signature"],
            )

    return docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text").mapInArrow(
        sign,
        f"doc_id {kind_of(docs, 'doc_id')}, text_key binary, n_shingles long, node long, "
        "signature binary",
    )


def candidates(classes: DataFrame, second: bool) -> DataFrame:
    """``a, b, agreeing, la, lb`` with a < b: neighbours whose signatures agree.

    `classes` has a row per class, with ``node``, ``signature``, ``label`` and ``full``;
    la and lb are the labels, the smaller one first. In the `second` look, these are
    the neighbours within the window that have different labels and are not both
    known as full; in the first, the nearest neighbours, and (x, x) for each end x
    of a candidate further off. Both have (x, x) with agreeing = 1 for each full class x.
    The rows of a tree are dealt by ranges that include the node, so that a
    region of any density spreads over tasks; the border between two tasks
    hides a pair in one tree only.
    """
    values, least = (
        (SECOND_VALUES, SECOND_AGREEING) if second else (FIRST_VALUES, FIRST_AGREEING)
    )

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.frombuffer(
                b"".join(batch.column("signature").to_pylist()), np.uint8
            ).reshape(-1, VALUES)
            for tree, order in enumerate(TREES[values]):
                rows = np.ascontiguousarray(table[:, order]).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(table), tree, np.int32)),
                        pa.array(
                            [rows[i : i + values] for i in range(0, len(rows), values)],
                            pa.binary(),
                        ),
                        batch.column("node"),
                        batch.column("label"),
                        batch.column("full"),
                    ],
                    ["tree", "ordered", "node", "label", "full"],
                )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = np.empty(0, np.int32)
        table = np.empty((0, values), np.uint8)
        nodes, labels = np.empty(0, np.int64), np.empty(0, np.int64)
        dense = np.empty(0, bool)
        for batch in batches:
            new = len(nodes)
            ordered = np.frombuffer(b"".join(batch.column("ordered").to_pylist()), np.uint8)
            trees = np.concatenate([trees, batch.column("tree").to_numpy()])
            table = np.concatenate([table, ordered.reshape(-1, values)])
            nodes = np.concatenate([nodes, batch.column("node").to_numpy()])
            labels = np.concatenate([labels, batch.column("label").to_numpy()])
            flags = batch.column("full").to_numpy(zero_copy_only=False).astype(bool)
            dense = np.concatenate([dense, flags])
            far = []
            for step in range(1, min(WINDOW, len(nodes) - 1) + 1):
                first, after = table[:-step], table[step:]
                near = (trees[:-step] == trees[step:]) & (
                    first[:, :LEAST_DEPTH] == after[:, :LEAST_DEPTH]
                ).all(axis=1)
                if second:
                    near &= labels[:-step] != labels[step:]
                    near &= ~(dense[:-step] & dense[step:])
                near[: max(0, new - step)] = False
                at = np.flatnonzero(near)
                agreeing = (first[at] == after[at]).sum(axis=1)
                at, agreeing = at[agreeing >= least], agreeing[agreeing >= least]
                if second or step <= NEAREST:
                    yield _pairs(nodes[at], nodes[at + step], agreeing, labels[at], labels[at + step])
                else:
                    far += [nodes[at], nodes[at + step]]
            if far:
                ends = np.unique(np.concatenate(far))
                yield _pairs(ends, ends, np.zeros(len(ends)), ends, ends)
            over = WINDOW + 1
            if len(nodes) > over:
                full = (trees[:-over] == trees[over:]) & (
                    table[:-over, :FULL_DEPTH] == table[over:, :FULL_DEPTH]
                ).all(axis=1)
                ends = np.unique(np.concatenate([nodes[:-over][full], nodes[over:][full]]))
                yield _pairs(ends, ends, np.ones(len(ends)), ends, ends)
            trees, table = trees[-over:], table[-over:]
            nodes, labels, dense = nodes[-over:], labels[-over:], dense[-over:]

    return (
        classes.select("node", "signature", "label", "full")
        .mapInArrow(plant, "tree int, ordered binary, node long, label long, full boolean")
        .repartitionByRange("tree", "ordered", "node")
        .sortWithinPartitions("tree", "ordered", "node")
        .mapInArrow(look, "a long, b long, agreeing int, la long, lb long")
        .groupBy("a", "b", "la", "lb")
        .agg(F.max("agreeing").alias("agreeing"))
    )


def _pairs(
    a: np.ndarray, b: np.ndarray, agreeing: np.ndarray, la: np.ndarray, lb: np.ndarray
) -> pa.RecordBatch:
    columns = [
        np.minimum(a, b), np.maximum(a, b), agreeing.astype(np.int32),
        np.minimum(la, lb), np.maximum(la, lb),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in columns], ["a", "b", "agreeing", "la", "lb"]
    )


def confirmed(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """The pairs whose full sets are similar enough; `texts` has ``node`` and ``text``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = ShingleSets(words)
        for batch in small_batches(batches):
            found = []
            for one, two in zip(
                batch.column("one").to_pylist(), batch.column("two").to_pylist(), strict=True
            ):
                first, second = shingles(one), shingles(two)
                shared = len(np.intersect1d(first, second, assume_unique=True))
                union = len(first) + len(second) - shared
                found.append(100 * shared >= SIMILAR * union)
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    return (
        pairs.select("a", "b")
        .join(texts.toDF("a", "one"), "a")
        .join(texts.toDF("b", "two"), "b")
        .select("a", "b", "one", "two")
        .mapInArrow(compare, "a long, b long")
    )


def firsts(texts: DataFrame, words: int) -> DataFrame:
    """``shingle, node, size, place``: of every set the rarest shingles that others share.

    Shingles go by the number of the given sets that have them, then by their
    value; ``place`` counts from 0. Of two sets of similarity 0.8, each holds all but
    a fifth of the union, so in this order the first fifth of the one meets that of
    the other. `texts` has ``node`` and ``text``.
    """

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = ShingleSets(words)
        for batch in small_batches(batches, 32):
            sets = [shingles(text) for text in batch.column("text").to_pylist()]
            many = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)),
                    pa.array(np.repeat(batch.column("node").to_numpy(), many)),
                    pa.array(np.repeat(np.array(many, np.int64), many)),
                ],
                ["shingle", "node", "size"],
            )

    rows = stored(
        texts.select("node", "text").mapInArrow(every, "shingle long, node long, size long"),
        "full-shingles",
    )
    counts = rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    own = Window.partitionBy("node")
    # What no other set has comes before all that is shared.
    place = F.col("size") - F.count("*").over(own) + F.row_number().over(
        own.orderBy("n", "shingle")
    ) - 1
    shared = F.ceil(F.col("size") * SIMILAR / 100)
    return (
        rows.join(counts, "shingle")
        .withColumn("place", place)
        .where(F.col("place") <= F.col("size") - shared)
        .select("shingle", "node", "size", "place")
    )


def sharing(first: DataFrame, classes: DataFrame, turn: str) -> DataFrame:
    """``a, b`` with a < b and different labels that share one of their rarest shingles.

    Of those, the pairs whose sizes and places allow the similarity; in the turn
    "hubs" only those that hold a hub, in the turn "one" only the one of any two labels
    in a cell whose short signatures agree best. `first` is the result of `firsts`,
    `classes` has ``node, label, hub, short``. The classes with a shingle are dealt into parts; any
    two parts meet in a cell, and only the pairs leave it.
    """
    rows = stored(first.join(classes, "node"), "shingles", rows=first.count())
    shared = (
        rows.groupBy("shingle")
        .agg(
            F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"),
            F.max("hub").alias("any"),
        )
        .where("low < high and any" if turn == "hubs" else "low < high")
        .select("shingle", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("parts"))
    )
    keys = ["shingle", "i", "j"]
    cells = (
        rows.join(shared, "shingle")
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("i", F.least("part", "other"))
        .withColumn("j", F.greatest("part", "other"))
        .select(*keys, "part", "node", "label", "hub", "short", "size", "place")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            some = pa.Table.from_batches([batch])
            some = some if rest is None else pa.concat_tables([rest, some])
            last = int(_cells(some)[-1])
            if last:
                yield _met(some.slice(0, last), turn)
            rest = some.slice(last)
        if rest is not None:
            yield _met(rest, turn)

    return (
        cells.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(meet, "a long, b long")
        .distinct()
    )


def _cells(rows: pa.Table) -> np.ndarray:
    """Where the cells of the sorted rows begin."""
    key = np.stack([rows.column(k).to_numpy().astype(np.int64) for k in ("shingle", "i", "j")])
    return np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))


def _met(rows: pa.Table, turn: str) -> pa.RecordBatch:
    """The pairs of `sharing` in whole cells."""
    i, j, part, node, label, hub, size, place = (
        rows.column(c).to_numpy()
        for c in ("i", "j", "part", "node", "label", "hub", "size", "place")
    )
    starts = _cells(rows)
    sizes = np.diff(np.append(starts, len(node)))
    ends = np.repeat(starts + sizes, sizes)
    found, at, step = [np.empty((2, 0), np.int64)], np.arange(len(node)), 1
    while len(at := at[at + step < ends[at]]):
        # A cell of two parts pairs only one with the other.
        x = at[label[at] != label[at + step]]
        x = x[(part[x] != part[x + step]) | (i[x] == j[x])]
        if turn == "hubs":
            x = x[hub[x] | hub[x + step]]
        y = x + step
        # What lies from here on in both is the most that they share, if this is the
        # first they share; where it is not, the first lets the pair through.
        most = np.minimum(size[x] - place[x], size[y] - place[y])
        near = most * (100 + SIMILAR) >= SIMILAR * (size[x] + size[y])
        found.append(np.stack([x[near], y[near]]))
        step += 1
    x, y = np.concatenate(found, axis=1)
    if turn == "one":
        short = np.frombuffer(b"".join(rows.column("short").to_pylist()), np.uint8)
        short = short.reshape(-1, SHORT_VALUES)
        alike = np.concatenate(
            [np.empty(0, np.int64)]
            + [
                (short[x[k : k + PAIRS_AT_ONCE]] == short[y[k : k + PAIRS_AT_ONCE]]).sum(axis=1)
                for k in range(0, len(x), PAIRS_AT_ONCE)
            ]
        )
        cell = np.repeat(starts, sizes)[x]
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        order = np.lexsort((node[x], alike, high, low, cell))
        key = np.stack([cell, low, high])[:, order]
        last = np.append((key[:, 1:] != key[:, :-1]).any(axis=0), True)[: len(order)]
        x, y = x[order][last], y[order][last]
    a, b = np.unique(np.sort(np.stack([node[x], node[y]]), axis=0), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def linked(docs: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """``node, label``: the component of every class with a confirmed link.

    `rows` is the stored result of `signed`.
    """
    classes = stored(
        rows.where("node is not null")
        .groupBy("node")
        .agg(
            F.first("signature").alias("signature"),
            F.min(F.struct("doc_id", "text_key")).alias("own"),
        ),
        "classes",
        rows=rows.count(),
    )
    n_classes = classes.count()
    start = classes.withColumns({"label": F.col("node"), "full": F.lit(False)})
    nearest = stored(candidates(start, second=False), "nearest", rows=n_classes)
    ends = nearest.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    full = nearest.where("a = b and agreeing = 1").select(F.col("a").alias("node"))
    classes = stored(
        classes.join(ends, "node", "left_semi")
        .join(full.distinct().withColumn("full", F.lit(True)), "node", "left")
        .withColumn("full", F.coalesce("full", F.lit(False))),
        "candidate-classes",
        rows=n_classes,
    )
    n_classes = classes.count()
    # One document stands for its class, so that no text moves once per copy.
    one = classes.select(
        "node", F.col("own.doc_id").alias("own_id"), F.col("own.text_key").alias("own_key")
    )
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("own_key"))
    texts = stored(
        keyed.join(one, ["own_key"])
        .where(F.col("doc_id").eqNullSafe(F.col("own_id")))
        .groupBy("node")
        .agg(F.first("text").alias("text")),
        "candidate-texts",
        rows=n_classes,
    )
    nearest = nearest.where("a != b").select("a", "b", "agreeing")
    both = nearest.union(nearest.select("b", "a", "agreeing")).toDF("node", "other", "agreeing")
    rank = F.xxhash64("other")
    chosen = (
        both.groupBy("node")
        .agg(
            F.max_by("other", F.struct("agreeing", rank)).alias("best"),
            F.min_by("other", rank).alias("leader"),
        )
        .select("node", F.explode(F.array("best", "leader")).alias("other"))
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        .distinct()
    )
    tried = stored(chosen, "tried", rows=2 * n_classes)
    found = _links(tried, texts, words)
    labels = stored(components(found), "labels", rows=n_classes)
    relabelled = classes.join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    relabelled = stored(relabelled, "relabelled", rows=n_classes)
    second = stored(candidates(relabelled, second=True), "second", rows=n_classes)
    scaled = F.expr(f"cast(agreeing * {SECOND_VALUES} / {FIRST_VALUES} as int)")
    dense = classes.where("full").select("node")
    untried = nearest.withColumn("agreeing", scaled).join(tried, ["a", "b"], "left_anti")
    known = untried.join(dense.toDF("a"), "a", "left_semi").join(dense.toDF("b"), "b", "left_semi")
    untried = untried.join(known.select("a", "b"), ["a", "b"], "left_anti")
    pairs = stored(
        second.where("a != b")
        .join(tried, ["a", "b"], "left_anti")
        .unionByName(_apart(untried, labels))
        .groupBy("a", "b", "la", "lb")
        .agg(F.max("agreeing").alias("agreeing")),
        "apart",
        rows=nearest.count() + second.count(),
    )
    n_pairs = pairs.count()
    best = F.max_by(F.struct("a", "b"), F.struct("agreeing", "a", "b")).alias("pair")
    new = stored(pairs.groupBy("la", "lb").agg(best).select("pair.*"), "tried", rows=n_pairs)
    fresh = _links(new, texts, words)
    found, labels = found.union(fresh), joined(labels, fresh)
    rest = stored(
        _apart(pairs.join(new, ["a", "b"], "left_anti"), labels), "apart", rows=n_pairs
    )
    fresh = _links(rest, texts, words)
    found, labels = found.union(fresh), joined(labels, fresh)

    over = second.where("a = b").select(F.col("a").alias("node"))
    full = stored(dense.union(over).distinct(), "full", rows=n_classes)
    n_full = full.count()
    if not n_full:
        return labels
    first = stored(
        firsts(texts.join(full, "node", "left_semi"), words), "firsts", n_full, SETS_A_TASK
    )
    n_first = first.count()
    done = None
    for turn in ("hubs", "one", "all"):
        hub = _hubs(found, labels).withColumn("hub", F.lit(True))
        marked = (
            full.join(classes, "node")
            .select("node", F.substring("signature", 1, SHORT_VALUES).alias("short"))
            .join(labels, "node", "left")
            .join(hub, "node", "left")
            .select(
                "node", F.coalesce("label", "node").alias("label"),
                F.coalesce("hub", F.lit(False)).alias("hub"), "short",
            )
        )
        pairs = sharing(first, marked, turn)
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = stored(pairs, "sharing", rows=n_first)
        done = pairs if done is None else done.union(pairs)
        fresh = _links(pairs, texts, words)
        found, labels = found.union(fresh), joined(labels, fresh)
    return labels


def _links(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """The stored pairs that are `confirmed`, stored."""
    return stored(confirmed(pairs, texts, words), "links", pairs.count(), PAIRS_A_TASK)


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels once the ends of some more links are joined."""
    n_links = links.count()
    if not n_links:
        return labels
    between = _apart(links.withColumn("agreeing", F.lit(0)), labels)
    merged = components(between.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    every = labels.unionByName(
        ends.join(labels, "node", "left_anti").withColumn("label", F.col("node"))
    )
    return stored(
        every.join(merged.toDF("label", "to"), "label", "left").select(
            "node", F.coalesce("to", "label").alias("label")
        ),
        "labels",
        rows=labels.count() + 2 * n_links,
    )


def _hubs(links: DataFrame, labels: DataFrame) -> DataFrame:
    """``node``: of each component the class with most links."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node"))
    return (
        ends.groupBy("node").agg(F.count("*").alias("n"))
        .join(labels, "node")
        .groupBy("label")
        .agg(F.max_by("node", F.struct("n", "node")).alias("node"))
        .select("node")
    )


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components, ``la`` and ``lb``."""
    one = F.coalesce(F.col("_la"), F.col("a"))
    two = F.coalesce(F.col("_lb"), F.col("b"))
    return (
        pairs.select("a", "b", "agreeing")
        .join(labels.toDF("a", "_la"), "a", "left")
        .join(labels.toDF("b", "_lb"), "b", "left")
        .where(one != two)
        .select(
            "a", "b", "agreeing", F.least(one, two).alias("la"), F.greatest(one, two).alias("lb")
        )
    )


def near_duplicates(docs: DataFrame, words: int = 5) -> DataFrame:
    """Per document: ``doc_id, text_key, n_shingles, component_id, kept``.

    The component is named by its smallest ``doc_id``; null ids never name one
    that has another id, and a component of null ids is named null. ``kept`` is
    true for rows with the naming id, so a repeated row is kept each time. A
    text without words is linked with nothing and names its own component.
    """
    rows = stored(signed(docs, words), "signed")
    labels = linked(docs, rows, words)
    least = (
        rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    )
    names = (
        least.join(labels, "node").groupBy("label").agg(F.min("least").alias("component_id"))
    )
    names = stored(names, "component-names", rows=labels.count())
    members = labels.join(names, "label").drop("label")
    named = stored(
        least.join(members, "node", "left").select(
            "node",
            F.when(F.col("component_id").isNull(), F.col("least"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
        ),
        "named-classes",
        rows=rows.count(),
    )
    return (
        rows.join(named, "node", "left")
        .withColumn(
            "component_id",
            F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")),
        )
        .select(
            "doc_id", "text_key", "n_shingles", "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
