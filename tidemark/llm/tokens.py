"""Words of a text, and token ids of a public tokenizer, inside tasks."""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex

from tidemark.llm.memory import Recent

ID_BYTES = 4
ID_TYPE = "<u4"
LATIN_LETTERS = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
PLAIN = {*map(chr, range(0x21, 0x7F)), *LATIN_LETTERS}


def words_of(text: str | None) -> list[bytes]:
    """The maximal runs of bytes other than the ASCII white space 0x20 and 0x09 to 0x0D."""
    return text.encode().split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """The words with A-Z in lower case; other letters stay as they are."""
    return text.encode().lower().split() if text else []


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Token ids of whole texts, word by word.

    A tokenizer that treats white space as a separator gives a text the ids of
    its words, one after the other, and most words of a corpus come back. So
    the ids of recent words are kept, in two generations of about `room` bytes.
    The pre-tokenizer cuts words into pieces: those of letters alone are kept as the
    words that they are, the others in an eighth of that room. The ids are those of
    ``Tokenizer.encode`` over the whole text.

    Words of printable ASCII and Latin-1 letters, on which lower case and
    normal form are plain, are cut with the tokenizer's own pattern here; all
    others pass through its normalizer and pre-tokenizer.
    """

    def __init__(self, path: str, room: int = 116 << 20) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)").search
        plain = PLAIN - {name[0] for name in special}
        self._plain = re.compile(f"[{re.escape(''.join(plain))}]+").fullmatch
        letters, others = (
            "".join(f"\\x{{{ord(c):x}}}" for c in sorted(plain) if fits(c))
            for fits in (str.isalpha, lambda c: not c.isalnum())
        )
        self._lettered = f"^(?P<letters>[{letters}]+)(?P<tail>[{others}]*)$"
        self._room = room
        self.forget()
        self._model_of = self._tokenizer.model.tokenize
        split = json.loads(self._tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]
        self._cut = regex.compile(split["pattern"]["Regex"]).findall
        self._shown = {
            ord(c): self._tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in LATIN_LETTERS
        }

    def forget(self) -> None:
        """Give up all words and pieces that are kept; later ones are kept again."""
        self._words = Recent(self._word, self._room)
        self._pieces = Recent(self._piece, self._room // 8)

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.translate(self._shown)
        return packed([t.id for t in self._model_of(shown)])

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if self._plain(text):
            lower = text.lower()
            if lower.isalpha():
                return self._piece(text) if lower == text else self._words[lower.encode()]
            if lower[:-1].isalpha() and not lower[-1].isalnum():
                return self._words[lower[:-1].encode()] + self._pieces[lower[-1]]
            return b"".join(
                [
                    self._words[piece.encode()] if piece.isalpha() else self._pieces[piece]
                    for piece in self._cut(lower)
                ]
            )
        if self._special(text):
            return packed(self._tokenizer.encode(text, add_special_tokens=False).ids)
        normal = self._tokenizer.normalizer.normalize_str(text)
        pieces = self._tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        return packed([t.id for piece, _ in pieces for t in self._model_of(piece)])

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers; none for no text."""
        return b"".join(map(self._words.__getitem__, words_of(text)))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """What `encode` gives of every text, each word looked up once for all of them.

        Of words of plain letters, in small letters or not and with other characters after
        them or not, only the letters are kept: the room is for what the tokenizer must cut.
        """
        cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = cut.values.dictionary_encode()
        parts = pc.extract_regex(words.dictionary, self._lettered)
        letters = pc.utf8_lower(parts.field("letters"))
        ids = pc.binary_join_element_wise(
            _each(self._words.__getitem__, letters), _each(self._tail, parts.field("tail")), b""
        )
        other = parts.is_null()
        rest = _each(self._words.__getitem__, words.dictionary.filter(other))
        ids = pc.replace_with_mask(ids, other, rest).take(words.indices)
        return pc.binary_join(pa.ListArray.from_arrays(cut.offsets, ids), b"").to_pylist()

    def _tail(self, tail: bytes) -> bytes:
        return b"".join([self._pieces[piece] for piece in self._cut(tail.decode())])


def _each(ids_of: Callable[[bytes], bytes], words: pa.Array) -> pa.Array:
    """The ids of every word, asked for once for equal ones; null for null."""
    coded = words.dictionary_encode()
    different = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    return pa.array(list(map(ids_of, different)), pa.binary()).take(coded.indices)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, which keeps its words from task to task."""
    return WordEncoder(path)
