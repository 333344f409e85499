"""Byte-level BPE against the merges themselves and the library that shares the ranks."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.samples import documents, odd_rows, prose, with_extra
from tidemark.llm import bytepairs, queries
from tidemark.llm.memory import Recent

PATTERN = public_tokenizers.PATTERN
BITS = ["a", "e", " ", "  ", "\n", "'s", "'re", "é", "日", "\U0001f600", "1", "22", "!", "--",
        "the", "ing", "aaaa", "\t", "\xa0", "\x85", "ß"]
TEXTS = st.lists(st.sampled_from(BITS), max_size=40).map("".join)


@pytest.fixture(scope="module")
def coder():
    return bytepairs.codec(queries.RANKS, PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=coder.vocabulary.ranks, special_tokens={}
    )


def ids_of(library, text) -> bytes:
    return np.array(library.encode_ordinary(text or ""), "<u4").tobytes()


def by_merges(vocabulary, data) -> list[bytes]:
    return list(vocabulary.merges(data))[-1]


def test_pairs_stay_apart_as_the_merges_say(coder):
    vocabulary, pick = coder.vocabulary, random.Random(1)
    ids = list(vocabulary.tokens)
    for _ in range(20_000):
        one = pick.choice(pick.choice([ids, ids[:2000]]))
        two = pick.choice(pick.choice([ids, ids[:2000]]))
        both = [vocabulary.tokens[one], vocabulary.tokens[two]]
        apart = by_merges(vocabulary, b"".join(both)) == both
        assert vocabulary._fit(one * vocabulary._many + two) == apart


def test_equal_ranks_merge_from_the_left_and_unmade_tokens_end_no_prefix():
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"aaaa": 3, b"aba": 4}
    vocabulary = bytepairs.Vocabulary(ranks)
    for data in (b"aaa", b"aaaaa", b"aaaaaaa", b"aba", b"abaaba", b"baaab"):
        found = vocabulary.tokens_of(vocabulary.prefixes(data))
        assert [vocabulary.tokens[i] for i in found] == by_merges(vocabulary, data)


@settings(max_examples=300, deadline=None)
@given(TEXTS, TEXTS, st.integers(0, 100), st.integers(0, 6))
def test_texts_appends_and_edits(coder, library, text, put, at, size):
    vocabulary = coder.vocabulary
    ids = coder.encode(text)
    assert ids == ids_of(library, text)
    assert coder.decode(ids) == text.encode()
    start = min(at, len(text))
    stop = min(start + size, len(text))
    changed, new = coder.edited(text, ids, start, stop, put)
    assert changed == text[:start] + put + text[stop:]
    assert new == ids_of(library, changed)
    data, low, high = text.encode(), len(text[:start].encode()), len(text[:stop].encode())
    last = vocabulary.prefixes(data)
    assert vocabulary.appended(data[:low], last[:low], data[low:]) == last
    replaced = vocabulary.replaced(data, last, low, high, put.encode())
    assert replaced == vocabulary.prefixes(changed.encode())
    assert [vocabulary.tokens[i] for i in vocabulary.tokens_of(last)] == by_merges(vocabulary, data)


def test_an_edit_leaves_what_is_far_from_it(coder, monkeypatch):
    text = prose(3, 4000)
    ids = coder.encode(text)
    seen = []
    monkeypatch.setattr(coder, "_matches", lambda t: seen.append(t) or regex.findall(PATTERN, t))
    changed, new = coder.edited(text, ids, 9000, 9003, "Zz")
    assert sum(map(len, seen)) < 100
    assert new == coder.encode(changed)
    data = b"ab" * 5000
    vocabulary = coder.vocabulary
    last = vocabulary.prefixes(data)
    changed = vocabulary.prefixes(data[:4000] + b"zz" + data[4000:])
    asked = []
    fits = vocabulary._fits

    class Counted:
        def __getitem__(self, pair):
            asked.append(pair)
            return fits[pair]

    monkeypatch.setattr(vocabulary, "_fits", Counted())
    assert vocabulary.replaced(data, last, 4000, 4000, b"zz") == changed
    assert len(asked) < 500


def test_every_character_is_cut_as_the_library_does(coder, library):
    for at in range(0, 0x11000, 7):
        if not 0xD800 <= at < 0xE000:
            c = chr(at)
            text = f"a{c}b{c}{c}1{c}!"
            assert coder.encode(text) == ids_of(library, text)


def test_a_bounded_memory_keeps_what_is_asked_for_and_makes_the_rest_anew():
    made = []
    memory = Recent(lambda key: made.append(key) or key * 2, room=1000)
    for i in range(100):
        assert memory[b"often"] == b"oftenoften"
        assert memory[str(i).encode()] == str(i).encode() * 2
        assert len(memory) + len(memory._older) < 20
    assert made.count(b"often") == 1
    assert memory[b"0"] == b"00" and made.count(b"0") == 2


def test_tables(spark, library):
    rows = odd_rows()
    docs = with_extra(documents(spark, rows))
    coded = bytepairs.encoded(docs, queries.RANKS, PATTERN)
    back = bytepairs.decoded(coded, queries.RANKS, PATTERN).collect()
    want = sorted(repr((r[0], ids_of(library, r[1]), (r[1] or "").encode())) for r in rows)
    assert want == sorted(repr((r.doc_id, bytes(r.ids), bytes(r.decoded))) for r in back)
    edits = [
        (r[1], bytes(ids_of(library, r[1])), start, stop, put)
        for r in rows for start, stop, put in [(0, 2, "ha "), (3, 3, None), (None, None, " end")]
    ]
    frame = spark.createDataFrame(edits, "text string, ids binary, start int, stop int, put string")
    for r in bytepairs.reencoded(frame, queries.RANKS, PATTERN).collect():
        assert bytes(r.edited_ids) == ids_of(library, r.edited_text)
        assert r.edited_text.endswith(r.put or "") or r.start == 0
    empty = bytepairs.encoded(documents(spark, []), queries.RANKS, PATTERN)
    assert empty.collect() == []
