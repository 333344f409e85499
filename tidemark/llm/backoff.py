"""Language-model scores from a weighted backoff automaton.

The model holds n-grams up to `ORDER`, smoothed by interpolation: with c the
training count, P(w | h) = (1 - m) c(hw) / c(h) + m P(w | h'), where h' is h
without its first word and the mass m depends on the size class of c(h). The
mass is what leaving one out finds unseen: the share of training positions in
that size class whose n-gram occurs just once. Below the unigrams lies one
unknown word with the mass of the words seen once. So the probabilities of all
known words and the unknown one add up to 1 in every state.

As an automaton: n-grams are states, an arc carries the log probability of a
word, and the failure arc of a state carries log m to the state of h'. A text
is read once from left to right, starting in the state of a text's end: its state
takes the arc of the next word, or its failure arc and tries again from there.
All texts of a block are read side by side, each with a state of its own.

The n-grams of a corpus fit no machine, so none holds them. Documents are put
into blocks; each block sends the hashes of its distinct n-grams with their
training counts to the ranges of the hash that they belong to, where counts are
summed over all blocks and go back to the blocks that asked. A block then
builds the part of the automaton that its own texts can reach. An n-gram is one
entry per block however often it occurs there, so frequent words are no hot
keys, and the number of ranges follows the number of tokens. Words are hashed
to 64 bits, longer n-grams to `GRAM_BITS`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import kind_of, stored
from tidemark.llm.tokens import lower_words_of

ORDER = 2
BLOCK_TOKENS = 1_400_000
RANGE_TOKENS = 4_000_000
GRAM_BITS = 48
CLASSES = 64

END = b"\n"  # No word holds it.
MIX = np.uint64(0x9E3779B97F4A7C15)


def bits_of(order: int) -> int:
    return 64 if order == 1 else GRAM_BITS


def squeezed(values: np.ndarray) -> bytes:
    """Integers as a compressed block of their byte planes; most high bytes are zero."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unsqueezed(packed: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    planes = raw.reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def rising(values: np.ndarray) -> bytes:
    return squeezed(np.diff(values, prepend=np.uint64(0)))


def risen(packed: bytes) -> np.ndarray:
    return np.cumsum(unsqueezed(packed, np.uint64), dtype=np.uint64)


@dataclass
class Grams:
    """The distinct n-grams of one order in a block.

    `at` gives the n-gram that ends at each position (-1: none there), `context`
    and `word` its parts, by which n-grams are sorted, `suffix` the n-gram without its
    first word. `keys` are the distinct hashes, `key_of` the place of each n-gram
    among them.
    """

    at: np.ndarray
    context: np.ndarray
    word: np.ndarray
    suffix: np.ndarray
    hashes: np.ndarray
    keys: np.ndarray
    key_of: np.ndarray

    def counts(self, training: np.ndarray) -> np.ndarray:
        """Training occurrences per key."""
        found = self.at[training & (self.at >= 0)]
        own = np.bincount(found, minlength=len(self.word))
        return np.bincount(self.key_of, own, len(self.keys)).astype(np.uint32)


def grams_of(vocabulary: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> list[Grams]:
    """The n-grams of orders 1 to `ORDER`; `vocabulary` holds the hashes of the words."""
    end = int(np.searchsorted(vocabulary, hash_of(END)))
    first = np.zeros(len(tokens), bool)
    first[np.cumsum(sizes) - sizes] = True
    order = np.arange(len(vocabulary), dtype=np.int32)
    none = np.zeros(len(vocabulary), np.int32)
    grams = [Grams(tokens, none, order, none, vocabulary, vocabulary, order)]
    for n in range(2, ORDER + 1):
        shorter = grams[-1]
        context = np.concatenate([np.array([-1], np.int32), shorter.at[:-1]])
        context[first] = end if n == 2 else -1
        there = np.flatnonzero(context >= 0)
        code = context[there].astype(np.int64) * len(vocabulary) + tokens[there]
        distinct, place, inverse = np.unique(code, return_index=True, return_inverse=True)
        at = np.full(len(tokens), -1, np.int32)
        at[there] = inverse
        del code, inverse, context
        one, word = (x.astype(np.int32) for x in np.divmod(distinct, len(vocabulary)))
        mixed = (shorter.hashes[one] ^ np.uint64(n)) * MIX
        mixed = ((mixed ^ (mixed >> np.uint64(32))) + vocabulary[word]) * MIX
        hashes = mixed ^ (mixed >> np.uint64(29))
        keys, key_of = np.unique(hashes >> np.uint64(64 - GRAM_BITS), return_inverse=True)
        suffix = shorter.at[there[place]]
        grams.append(Grams(at, one, word, suffix, hashes, keys, key_of.astype(np.int32)))
    return grams


def hash_of(word: bytes) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(word))


class Numbers(dict):
    """Numbers words in the order of their first look-up."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def blocks_of(docs: DataFrame, held_out: Column) -> DataFrame:
    """Documents in blocks of about `BLOCK_TOKENS` tokens, their words as numbers."""
    kind = kind_of(docs, "doc_id")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        schema = None
        ids, out, sizes, numbers, known = [], [], [], [], Numbers()
        made = tokens = 0

        def block() -> pa.RecordBatch:
            hashes = np.array([hash_of(word) for word in known], np.uint64)
            vocabulary, place = np.unique(hashes, return_inverse=True)
            row = {
                "block": (task << 32) + made,
                "doc_ids": ids,
                "held_out": out,
                "sizes": sizes,
                "vocabulary": rising(vocabulary),
                "words": squeezed(place[np.concatenate(numbers)].astype(np.uint32)),
            }
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            if schema is None:
                schema = pa.schema(
                    [
                        ("block", pa.int64()),
                        ("doc_ids", pa.list_(batch.column("doc_id").type)),
                        ("held_out", pa.list_(pa.bool_())),
                        ("sizes", pa.list_(pa.int64())),
                        ("vocabulary", pa.binary()),
                        ("words", pa.binary()),
                    ]
                )
            for doc_id, text, apart in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = [*lower_words_of(text), END]
                ids.append(doc_id)
                out.append(apart)
                sizes.append(len(words))
                numbers.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                tokens += len(words)
                if tokens >= BLOCK_TOKENS:
                    yield block()
                    ids, out, sizes, numbers, known = [], [], [], [], Numbers()
                    made, tokens = made + 1, 0
        if ids:
            yield block()

    return docs.select(
        "doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out")
    ).mapInArrow(
        collect,
        f"block long, doc_ids array<{kind}>, held_out array<boolean>, sizes array<long>, "
        "vocabulary binary, words binary",
    )


def single_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows one after the other, as a row is a whole block."""
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


def opened(row: dict) -> tuple[list[Grams], np.ndarray, np.ndarray]:
    """N-grams of a block, sizes of its documents, and which positions train."""
    sizes = np.array(row["sizes"], np.int64)
    tokens = unsqueezed(row["words"], np.uint32).astype(np.int32)
    grams = grams_of(risen(row["vocabulary"]), tokens, sizes)
    return grams, sizes, np.repeat(~np.array(row["held_out"], bool), sizes)


def counted(blocks: DataFrame) -> DataFrame:
    """The blocks with the training counts of their n-grams over all blocks.

    Adds ``totals`` (per order, one count per key of the block) and ``tokens`` and
    ``distinct``: parts of the corpus totals, to be added up over all blocks.
    """
    many = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)))
    ranges = max(1, -(-(many.first()[0] or 0) // RANGE_TOKENS))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in single_rows(batch):
                grams, _, training = opened(row)
                for order, g in enumerate(grams, 1):
                    counts = g.counts(training)
                    high = (g.keys >> np.uint64(bits_of(order) - 32)) * np.uint64(ranges)
                    cuts = np.searchsorted(high >> np.uint64(32), np.arange(ranges + 1))
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "part": order * ranges + k,
                                "block": row["block"],
                                "keys": rising(g.keys[a:b]),
                                "counts": squeezed(counts[a:b]),
                            }
                            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
                            if a < b
                        ],
                        pa.schema(
                            [
                                ("part", pa.int64()),
                                ("block", pa.int64()),
                                ("keys", pa.binary()),
                                ("counts", pa.binary()),
                            ]
                        ),
                    )

    def add(key: tuple, group: pa.Table) -> pa.Table:
        rows = group.sort_by("block").to_pylist()
        keys = [risen(row["keys"]) for row in rows]
        counts = np.concatenate([unsqueezed(row["counts"], np.uint32) for row in rows])
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(place, counts, len(distinct)).astype(np.uint64)
        answers = np.split(totals[place], np.cumsum([len(k) for k in keys])[:-1])
        unigrams = key[0].as_py() // ranges == 1
        return pa.table(
            {
                "block": [row["block"] for row in rows],
                "part": [row["part"] for row in rows],
                "totals": pa.array([squeezed(a) for a in answers], pa.binary()),
                "tokens": [int(totals.sum()) * (unigrams and not i) for i in range(len(rows))],
                "distinct": [
                    int((totals > 0).sum()) * (unigrams and not i) for i in range(len(rows))
                ],
            }
        )

    def answer(key: tuple, block: pa.Table, answers: pa.Table) -> pa.Table:
        rows = answers.sort_by("part").to_pylist()
        totals = [
            squeezed(
                np.concatenate(
                    [unsqueezed(r["totals"], np.uint64) for r in rows if r["part"] // ranges == n]
                )
            )
            if any(r["part"] // ranges == n for r in rows)
            else None
            for n in range(1, ORDER + 1)
        ]
        block = block.append_column("totals", pa.array([totals], pa.list_(pa.binary())))
        for name in ("tokens", "distinct"):
            block = block.append_column(name, pa.array([sum(r[name] for r in rows)], pa.int64()))
        return block

    answers = (
        blocks.mapInArrow(ask, "part long, block long, keys binary, counts binary")
        .groupBy("part")
        .applyInArrow(
            add, "block long, part long, totals binary, tokens long, distinct long"
        )
    )
    columns = ", ".join(f"{n} {kind_of(blocks, n)}" for n in blocks.columns)
    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            answer, f"{columns}, totals array<binary>, tokens long, distinct long"
        )
    )


def totals_of(row: dict, grams: list[Grams]) -> list[np.ndarray]:
    """Training counts over the corpus of every n-gram of a block, by order."""
    return [
        unsqueezed(packed, np.uint64).astype(np.int64)[g.key_of]
        if packed is not None
        else np.zeros(0, np.int64)
        for packed, g in zip(row["totals"], grams, strict=True)
    ]


def size_class(count: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(count, 1)).astype(np.int64)


def masses(blocks: DataFrame) -> np.ndarray:
    """The backoff mass by order and size class of the context, from all blocks."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((ORDER, CLASSES, 2))
        for batch in batches:
            for row in single_rows(batch):
                grams, _, training = opened(row)
                totals = totals_of(row, grams)
                for n, g in enumerate(grams):
                    found = g.at[training & (g.at >= 0)]
                    size = (
                        size_class(totals[n - 1][g.context[found]])
                        if n
                        else np.zeros(len(found), np.int64)
                    )
                    once = totals[n][found] == 1
                    seen[n, :, 0] += np.bincount(size, minlength=CLASSES)
                    seen[n, :, 1] += np.bincount(size, once, CLASSES)
        n, size = np.nonzero(seen[:, :, 0])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(n.astype(np.int32)),
                pa.array(size.astype(np.int32)),
                pa.array(seen[n, size, 0].astype(np.int64)),
                pa.array(seen[n, size, 1].astype(np.int64)),
            ],
            ["level", "size", "positions", "once"],
        )

    rows = (
        blocks.mapInArrow(tally, "level int, size int, positions long, once long")
        .groupBy("level", "size")
        .agg(F.sum("positions").alias("positions"), F.sum("once").alias("once"))
        .collect()
    )
    mass = np.ones((ORDER, CLASSES))
    for row in rows:
        least = 1 / (row["positions"] + 1)
        mass[row["level"], row["size"]] = max(row["once"] / row["positions"], least)
        if row["level"] == 0:  # Known words keep a part even if all were seen once.
            mass[0, 0] = min(mass[0, 0], 1 - least)
    return mass


class Automaton:
    """The states and arcs that the texts of one block can reach.

    An n-gram that was seen in training is an arc from the state of its first
    words, with a log10 probability, and below the highest order also a state,
    with a failure arc to the state of the n-gram without its first word. An
    n-gram that was not seen is neither. State 0 is the root, whose failure is
    the unknown word.
    """

    def __init__(
        self, grams: list[Grams], totals: list[np.ndarray], mass: np.ndarray, corpus: int
    ) -> None:
        self.grams = grams
        self.known = [total > 0 for total in totals]
        self.arcs: list[np.ndarray] = []
        self.failures: list[np.ndarray] = []
        chance = np.zeros(0)
        for n, (g, total, known) in enumerate(zip(grams, totals, self.known, strict=True)):
            if n:
                below = totals[n - 1][g.context]
                share = mass[n][size_class(below)]
                chance = (1 - share) * total / np.maximum(below, 1) + share * chance[g.suffix]
            else:
                chance = (1 - mass[0, 0]) * total / max(corpus, 1)
            self.arcs.append(np.log10(np.where(known, chance, 1)))
            if n < len(grams) - 1:
                self.failures.append(np.log10(mass[n + 1][size_class(total)]))
        self.unknown = float(np.log10(mass[0, 0]))

        words = len(grams[0].word)
        self._arc_of = [g.context.astype(np.int64) * words + g.word for g in grams]

    def start(self, end: int, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Order and n-gram of the state after a text's end, once for each of some texts."""
        order = min(int(self.known[0][end]), len(self.grams) - 1)
        return np.full(texts, order), np.full(texts, end if order else 0)

    def step(self, order: np.ndarray, state: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Moves each state on by a word, in place; what that adds to the log10 probability."""
        total = np.zeros(len(words))
        moving = np.arange(len(words))
        for n in range(len(self.grams) - 1, -1, -1):
            own = order[moving] == n
            here = moving[own]
            if not len(here):
                continue
            if n:
                wanted = state[here].astype(np.int64) * len(self.known[0]) + words[here]
                arc = np.minimum(np.searchsorted(self._arc_of[n], wanted), len(self._arc_of[n]) - 1)
                found = (self._arc_of[n][arc] == wanted) & self.known[n][arc]
            else:
                arc = words[here]
                found = self.known[0][arc]
            taken, arc = here[found], arc[found]
            total[taken] += self.arcs[n][arc]
            # The longest n-gram that ends here and is a state.
            if n + 1 < len(self.grams):
                order[taken], state[taken] = n + 1, arc
            else:
                order[taken], state[taken] = n, self.grams[n].suffix[arc] if n else 0
            stuck = here[~found]
            if n:
                total[stuck] += self.failures[n - 1][state[stuck]]
                order[stuck] = n - 1
                state[stuck] = self.grams[n - 1].suffix[state[stuck]]
            else:
                total[stuck] += self.unknown
                state[stuck] = 0
            moving = np.concatenate([moving[~own], stuck])
        return total

    def read(self, first: np.ndarray, end: int) -> np.ndarray:
        """What each position adds to the log10 probability of its text.

        `first` marks where the block's texts start; they are read from left to right.
        """
        tokens = self.grams[0].at
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(tokens)))
        # The longest first, so that those with a next word are always in front.
        longest = np.argsort(-sizes, kind="stable")
        places = starts[longest]
        left = np.searchsorted(-sizes[longest], -np.arange(sizes.max(initial=0)), "left")
        order, state = self.start(end, len(sizes))
        total = np.zeros(len(tokens))
        for at, many in enumerate(left.tolist()):
            here = places[:many] + at
            total[here] = self.step(order[:many], state[:many], tokens[here])
        return total


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per document its log10 probability under the model of the other documents.

    `held_out` marks the documents that the model does not learn from (null:
    learns). Returns ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score``, where the base is an add-one unigram model. A null or
    empty text is its end alone. With no training document every base is that
    of an empty corpus and every score 0. Rows with equal ids count each.
    """
    blocks = stored(
        counted(stored(blocks_of(docs, held_out), "text-blocks")), "counted-blocks"
    )
    known = blocks.agg(F.sum("tokens"), F.sum("distinct")).first()
    corpus, distinct = known[0] or 0, known[1] or 0
    mass = masses(blocks)
    kind = kind_of(docs, "doc_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, row in enumerate(single_rows(batch)):
                grams, sizes, _ = opened(row)
                totals = totals_of(row, grams)
                words = grams[0].at
                count = totals[0][words]
                starts = np.cumsum(sizes) - sizes
                first = np.zeros(len(words), bool)
                first[starts] = True
                # Every text ends with the end.
                steps = Automaton(grams, totals, mass, corpus).read(first, int(words[-1]))
                base = np.log10((count + 1) / (corpus + distinct + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[at].values,
                        pa.array(row["held_out"], pa.bool_()),
                        pa.array(sizes),
                        pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                        pa.array(np.full(len(sizes), corpus)),
                        pa.array(np.add.reduceat(base, starts)),
                        pa.array(np.add.reduceat(steps, starts)),
                    ],
                    [
                        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                        "base_score", "score",
                    ],
                )

    return blocks.mapInArrow(
        read,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
