"""Spelling variants against the plain definition."""

from __future__ import annotations

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.samples import documents, folder, odd_rows, prose, row, with_extra
from tidemark.llm import queries, spelling


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(
        long[:i] + long[i + 1 :] == short for i in range(len(long))
    )


def plain_counts(rows) -> dict[str, int]:
    found: Counter = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def plain_variants(counts) -> list[tuple]:
    near = {w: [v for v in counts if one_apart(v, w)] for w in counts}
    forms = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 5 * n:
            forms[word] = best
    made = []
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        made.append((word, form, root, n, len(near[word]), counts.get(form)))
    return sorted(made)


LETTERS = "abé×"


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(LETTERS, min_size=6, max_size=9), min_size=1, max_size=40))
def test_lookup_finds_what_is_one_letter_apart(words):
    words = sorted(words)
    index = spelling.PositionIndex(words)
    for word in words:
        for half in range(3, 6):
            want = [w for w in words if one_apart(w, word) and min(len(w), len(word)) // 2 == half]
            found = index.near(word, half, tail=False)
            assert [w for k, w in enumerate(words) if found >> k & 1] == want
            found = index.near(word, half, tail=True)
            want = [w for w in want if w[:half] != word[:half]]
            assert [w for k, w in enumerate(words) if found >> k & 1] == want


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(4)
    base = ["".join(pick.choices("abc", k=pick.randint(6, 9))) for _ in range(60)]
    base += ["Straßenbahn", "Études", "études", "aaaaaa", "aaaaaaa", "aaaaaaaa"]
    made = [(w, 5 ** pick.randint(0, 4) + pick.randint(0, 3)) for w in base]
    words = [w for w, n in made for _ in range(n)]
    pick.shuffle(words)
    texts = [" ".join(words[i : i + 90]) for i in range(0, len(words), 90)]
    # Chains of forms: each word five times as often as the one before.
    chain = [("qwerty" + "z" * i, 5 ** (i + 1)) for i in range(5)]
    texts += [" ".join([w] * n) for w, n in chain]
    rows = [row(1000 + i, t) for i, t in enumerate(texts)] + odd_rows()
    return rows + [row(5000 + i, prose(i, 300).upper()) for i in range(20)]


@pytest.mark.parametrize("cell", [4096, 7])
def test_query_against_the_plain_definition(spark, tmp_path, rows, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL_WORDS", cell)
    monkeypatch.setattr(spelling, "COUNTED_ROWS", 50)
    docs = with_extra(documents(spark, rows))
    found = queries.op13_spelling_variants(spark, folder(spark, tmp_path, documents=docs))
    got = sorted(
        (r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()
    )
    want = plain_variants(plain_counts(rows))
    assert got == want
    assert any(r[2] != r[1] and r[1] for r in want) and len(want) > 100


def test_empty_and_null_rows(spark, tmp_path):
    for name, some in (("empty", []), ("nulls", [(None,) * 5] * 3)):
        path = folder(spark, tmp_path / name, documents=documents(spark, some))
        assert queries.op13_spelling_variants(spark, path).collect() == []
