"""Byte-level BPE from the last token of every prefix.

Of a byte string's prefixes each has one encoding, so one last token. A token t
that ends a prefix is that last token if and only if the last token u of what
comes before t stays apart from t when both are merged together. So the last
token of a prefix follows from those of shorter ones, the tokens of a string are
read backwards from its end, an append only adds entries, and after an edit the
entries before it stay and those after it come back as soon as as many in a row
as the longest token has bytes are what they were.

Texts are cut into matches of the tokenizer's pattern, each encoded by itself.
Ids are little-endian unsigned 32-bit integers. A null text is the empty one, and
has no ids; ids that no token has are an error. Rows are independent of one
another: null and repeated ids, ties and other columns make no difference.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.memory import Recent
from tidemark.llm.shared import kind_of, small_batches
from tidemark.llm.tokens import ID_BYTES, packed

NEVER = 1 << 40
# Between two characters of which the first is no white space and the second a
# space before something else, a match of the pattern ends in any text.
BORDER = r"(?<=\S) (?=\S)"
NEXT, LAST = regex.compile(BORDER).search, regex.compile("(?r)" + BORDER).search


class Vocabulary:
    """Tokens with their ranks: of all adjacent pairs, the one that makes the token
    of the lowest rank is merged, the leftmost first."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._many = max(self.tokens) + 1
        self._endings = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._endings.add_word(token.decode("latin-1"), (len(token), rank))
        self._endings.make_automaton()
        self._spines: dict[int, tuple] = {}
        self._fits = Recent(self._fit, room=24 << 20)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as file:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})

    def merges(self, data: bytes) -> Iterator[list[bytes]]:
        """What the data consists of, from single bytes to its tokens, merge by merge."""
        parts = [data[i : i + 1] for i in range(len(data))]
        yield parts
        while True:
            found = [
                (rank, at)
                for at in range(len(parts) - 1)
                if (rank := self.ranks.get(parts[at] + parts[at + 1])) is not None
            ]
            if not found:
                return
            _, at = min(found)
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]
            yield parts

    def _spine(self, token: int) -> tuple[list, list]:
        """What lies at the token's left and right end while it is merged.

        Each a list of (bytes, rank at which they become part of more), from the
        single byte on. A token that its own merges do not make has empty lists.
        """
        known = self._spines.get(token)
        if known is None:
            steps = list(self.merges(self.tokens[token]))
            known = [], []
            if len(steps[-1]) == 1:
                known = self._until([p[0] for p in steps]), self._until([p[-1] for p in steps])
            self._spines[token] = known
        return known

    def _until(self, pieces: list[bytes]) -> list[tuple[bytes, int]]:
        pieces = list(dict.fromkeys(pieces))
        ends = [self.ranks[p] for p in pieces[1:]] + [NEVER]
        return list(zip(pieces, ends, strict=True))

    def _fit(self, pair: int) -> bool:
        """Whether the two tokens stay apart when their bytes are merged together.

        What lies at the border on either side changes with the merges; the two meet
        if they make a token before either becomes part of more. Of equal ranks the
        merge further left comes first.
        """
        first, second = divmod(pair, self._many)
        before, after = self._spine(first)[1], self._spine(second)[0]
        if not before or not after:
            return False
        i = j = 0
        while True:
            (one, until), (two, till) = before[i], after[j]
            rank = self.ranks.get(one + two)
            if rank is not None and rank < until and rank <= till:
                return False
            if until == till == NEVER:
                return True
            if until <= till:
                i += 1
            else:
                j += 1

    def _extend(self, data: bytes, last: list[int], until: Callable | None = None) -> None:
        """Adds the last token of each prefix that `last` lacks, `until` says so of one."""
        done = len(last)
        base = max(0, done + 1 - self.longest)
        add, fits, many = last.append, self._fits, self._many
        for at, (size, token) in self._endings.iter(data.decode("latin-1"), base):
            if at < done:
                continue
            start = at + 1 - size
            if fits[last[start - 1] * many + token] if start else self._spine(token)[0]:
                add(token)
                done += 1
                if until is not None and until(done):
                    return

    def prefixes(self, data: bytes) -> list[int]:
        """The last token of every prefix of the data, the shortest first."""
        last: list[int] = []
        self._extend(data, last)
        return last

    def appended(self, data: bytes, last: list[int], more: bytes) -> list[int]:
        """The last tokens for ``data + more``, given those of `data`."""
        last = last[:]
        self._extend(data + more, last)
        return last

    def replaced(
        self, data: bytes, last: list[int], start: int, stop: int, put: bytes
    ) -> list[int]:
        """The last tokens once ``data[start:stop]`` is replaced by `put`."""
        changed = data[:start] + put + data[stop:]
        shift = len(changed) - len(data)
        made, same = last[:start], 0

        def settled(end: int) -> bool:
            nonlocal same
            if end > start + len(put):
                same = same + 1 if made[-1] == last[end - 1 - shift] else 0
            return same == self.longest

        self._extend(changed, made, settled)
        return made + last[len(made) - shift :]

    def tokens_of(self, last: list[int]) -> list[int]:
        """The ids of a byte string, read from the end of its last tokens."""
        ids, end = [], len(last)
        while end:
            ids.append(last[end - 1])
            end -= len(self.tokens[ids[-1]])
        return ids[::-1]


class TextCodec:
    """Ids of whole texts and back; remembers the ids of recent matches."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, room: int = 96 << 20) -> None:
        self.vocabulary = vocabulary
        self._matches = regex.compile(pattern).findall
        self._ids = Recent(self._piece, room)

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.vocabulary.ranks.get(data)
        if whole is not None:
            return packed([whole])
        return packed(self.vocabulary.tokens_of(self.vocabulary.prefixes(data)))

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self._ids.__getitem__, self._matches(text or "")))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, array("I", ids)))

    def edited(
        self, text: str, ids: bytes, start: int, stop: int, put: str
    ) -> tuple[str, bytes]:
        """The text with characters `start` to `stop` replaced, and its ids.

        Only what lies between the borders of matches next to the edit is encoded
        again; all other ids are those given.
        """
        changed = text[:start] + put + text[stop:]
        # A border needs a character on either side that the edit leaves alone.
        before, after = LAST(text, 0, start), NEXT(text, stop + 1)
        left = before.start() if before else 0
        right = after.start() if after else len(text)
        sizes = [len(self.vocabulary.tokens[i]) for i in array("I", ids)]
        borders = len(text[:left].encode()), len(text[:right].encode())
        low, high = ID_BYTES * np.searchsorted(np.cumsum(sizes), borders, "right")
        middle = self.encode(changed[left : len(changed) - (len(text) - right)])
        return changed, ids[:low] + middle + ids[high:]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> TextCodec:
    """The codec of this Python worker, which keeps its matches from task to task."""
    return TextCodec(Vocabulary.read(path), pattern)


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every document; `path` is the file of ranks."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in small_batches(batches):
            ids = [coder.encode(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"]
            )

    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind_of(docs, 'doc_id')}, ids binary"
    )


def decoded(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows with ``decoded``, the bytes of their ``ids``; null ids have none."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in small_batches(batches):
            data = [coder.decode(ids or b"") for ids in batch.column("ids").to_pylist()]
            yield batch.append_column("decoded", pa.array(data, pa.binary()))

    return rows.mapInArrow(decode, T.StructType([*rows.schema.fields]).add("decoded", "binary"))


def reencoded(edits: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows with ``edited_text`` and ``edited_ids``.

    A row has ``text`` and its ``ids``, and ``start, stop, put``: the characters from
    start to stop, counted from 0, are replaced by put. A null text or put is empty,
    and null places are the end of the text.
    """

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in small_batches(batches):
            made = []
            for text, ids, start, stop, put in zip(
                *(batch.column(c).to_pylist() for c in ("text", "ids", "start", "stop", "put")),
                strict=True,
            ):
                text = text or ""
                start = len(text) if start is None else min(start, len(text))
                stop = len(text) if stop is None else max(start, stop)
                made.append(coder.edited(text, ids or b"", start, stop, put or ""))
            texts, ids = zip(*made, strict=True) if made else ((), ())
            yield batch.append_column("edited_text", pa.array(texts, pa.string())).append_column(
                "edited_ids", pa.array(ids, pa.binary())
            )

    return edits.mapInArrow(
        edit,
        T.StructType([*edits.schema.fields]).add("edited_text", "string").add("edited_ids", "binary"),
    )
