"""Components against comparing all pairs; fingerprints; sharding; mixing; layouts."""

from __future__ import annotations

import json
import random
from collections import Counter, defaultdict
from hashlib import blake2b, sha256
from pathlib import Path
from zlib import crc32

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.samples import documents, odd_rows, prose, row
from tidemark.llm import buckets, chat, forest, graph, merkle, mixing
from tidemark.llm.shared import stored
from tidemark.sources import scratch


def shingle_set(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def true_components(rows, size):
    sets = [shingle_set(r[1], size) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, one in enumerate(sets):
        for j in range(i):
            two = sets[j]
            if one and 100 * len(one & two) >= 80 * len(one | two):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if sets[i] and r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return [
        (r[0], len(sets[i]), least.get(root(i)) if sets[i] else r[0]) for i, r in enumerate(rows)
    ]


def edited_copies(rng, text, many, edits):
    for _ in range(many):
        words = text.split()
        for at in rng.sample(range(len(words)), edits):
            words[at] = rng.choice(["X", "Y", "Z"]) + str(rng.random())
        yield " ".join(words)


@pytest.mark.parametrize("size", [2, 5])
def test_components_are_those_of_all_pairs(spark, size):
    rng = random.Random(size)
    rows = [r for r in odd_rows() if r[0] not in (6, 7)]
    common = prose(77, 14)
    texts = [f"{common}\n{prose(i, 60 + i)}" for i in range(40)]
    for i in range(12):
        texts += edited_copies(rng, prose(500 + i, 150), 3 + 5 * i, 1 + i % 7)
    rng.shuffle(texts)
    rows += [row(1000 + i, t) for i, t in enumerate(texts)]
    found = forest.near_duplicates(documents(spark, rows), size).collect()
    got = sorted((repr((r.doc_id, r.n_shingles, r.component_id)) for r in found))
    assert got == sorted(map(repr, true_components(rows, size)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_small_steps_have_no_file_per_shuffle_partition(spark):
    rng = random.Random(5)
    texts = [prose(i, 60) for i in range(60)]
    for edits in (1, 4):
        texts += edited_copies(rng, prose(500, 150), 60, edits)
    rows = [row(i, t) for i, t in enumerate(texts)]
    settings = {
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    cores = spark.sparkContext.defaultParallelism
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        with scratch.run_folder(spark) as steps:
            found = forest.near_duplicates(documents(spark, rows), 5)
            got = sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in found.collect())
            parts = {p.name: len(list(p.glob("part-*"))) for p in Path(steps).iterdir()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == sorted(map(repr, true_components(rows, 5)))
    named = {name.rsplit("-", 1)[0] for name in parts}
    assert {"classes", "nearest", "hooked", "firsts", "sharing", "named-classes"} <= named
    assert max(parts.values()) <= cores


def test_files_of_a_step_are_sized_by_its_rows(spark):
    frame = spark.range(3000).repartition(40, "id")
    cores = spark.sparkContext.defaultParallelism
    for rows, files in ((None, 40), (0, cores), (3000, max(30, cores)), (9000, 40)):
        found = stored(frame, "sized", rows, 100)
        assert len(found.inputFiles()) == files and found.distinct().count() == 3000


def test_components_of_paths_stars_and_cliques(spark):
    links = [(i, i + 1) for i in range(100, 160)]
    links += [(7, i) for i in range(200, 260)] + [(i, j) for i in range(30) for j in range(i)]
    rng = random.Random(1)
    rng.shuffle(links)
    frame = spark.createDataFrame(links, "a long, b long").repartition(5)
    groups = defaultdict(set)
    for node, label in graph.components(frame).collect():
        groups[label].add(node)
    assert sorted(map(sorted, groups.values())) == sorted(
        map(sorted, [range(100, 161), [*range(30), *range(200, 260)]])
    )
    assert graph.components(frame.limit(0)).collect() == []


def test_equal_texts_and_edits_of_a_merkle_tree():
    text = "\n".join([prose(1, 200), "", prose(2, 90)])
    lines = text.split("\n")
    changed = "\n".join([*lines[:5], lines[5] + " more", *lines[6:]])
    one, two = merkle.fingerprint(text), merkle.fingerprint(changed)
    assert merkle.fingerprint(str(text)) == one != two
    left, right = merkle.differing(one, two)
    assert [p.number for p in left] == [p.number for p in right] == [5]
    assert merkle.differing(one, one) == ([], [])
    assert merkle.likeness(one, one) == 1 > merkle.likeness(one, two) > 0.9
    assert merkle.likeness(one, merkle.fingerprint(prose(9, 300))) < 0.1
    assert merkle.fingerprint("a b") != merkle.fingerprint("a  b")
    assert merkle.likeness(merkle.fingerprint("a b"), merkle.fingerprint("a  b")) < 1
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint(" ")) == 0
    inserted = "\n".join([*lines[:3], "a new line", *lines[3:]])
    _, new = merkle.differing(one, merkle.fingerprint(inserted))
    assert [p.number for p in new] == [3]


def plain_print(text: str) -> str:
    """The fingerprint from its description, level by level."""
    def named(data, size):
        return blake2b(data, digest_size=size).digest()

    lines = text.encode().split(b"\n")
    own = [named(line, 8) for line in lines]
    ends = [i for i, line in enumerate(lines) if not line.split() or own[i][0] % 8 == 0]
    if not ends or ends[-1] != len(lines) - 1:
        ends.append(len(lines) - 1)
    starts = [0, *(end + 1 for end in ends[:-1])]
    sections, shown = [], []
    for start, end in zip(starts, ends, strict=True):
        sections.append(named(b"".join(own[start : end + 1]), 8))
        paragraphs = []
        for i in range(start, end + 1):
            words = lines[i].split()
            runs = [b" ".join(words[k : k + 4]) for k in range(0, len(words), 4)]
            leaves = "".join(f"{crc32(run) % 2**24:06x}" for run in runs)
            paragraphs.append(f"{own[i].hex()}.{len(words)}.{leaves}")
        shown.append(f"{sections[-1].hex()}:{','.join(paragraphs)}")
    return ";".join([named(b"".join(sections), 16).hex(), *shown])


def plain_likeness(one: str, two: str) -> float:
    """Shares of equal sections, then of equal lines, then of equal runs of words."""
    def parts(text):
        lines = text.split("\n")
        sections, current = [], []
        for line in lines:
            current.append(line)
            own = blake2b(line.encode(), digest_size=8).digest()
            if not line.split() or own[0] % 8 == 0:
                sections.append(tuple(current))
                current = []
        return sections + ([tuple(current)] if current else [])

    if one == two:
        return 1.0
    total = len(one.split()) + len(two.split())
    if not total:
        return 0.0
    first, second = Counter(parts(one)), Counter(parts(two))
    lines = [Counter(line for s in (x - y).elements() for line in s)
             for x, y in ((first, second), (second, first))]
    shared = sum(n * sum(len(line.split()) for line in s) for s, n in (first & second).items())
    shared += sum(n * len(line.split()) for line, n in (lines[0] & lines[1]).items())
    runs = []
    for x, y in ((lines[0], lines[1]), (lines[1], lines[0])):
        words = [line.split() for line in (x - y).elements()]
        runs.append(Counter(tuple(w[k : k + 4]) for w in words for k in range(0, len(w), 4)))
    shared += sum(n * len(run) for run, n in (runs[0] & runs[1]).items())
    return min(2 * shared / total, 1 - 1e-9)


def test_fingerprint_and_likeness_by_their_description():
    rng = random.Random(8)
    texts = ["", "a", "\n\n", "a b\n\nc", prose(1, 300), prose(2, 40), "x y z " * 30]
    for _ in range(60):
        lines = rng.choice(texts).split("\n")
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(lines) + 1)
            lines[at : at + rng.randint(0, 2)] = [prose(rng.randrange(99), rng.randint(1, 12))]
        texts.append("\n".join(lines))
    for text in texts:
        assert merkle.fingerprint(text) == plain_print(text)
        other = rng.choice(texts)
        got = merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(other))
        assert got == pytest.approx(plain_likeness(text, other), abs=1e-12)


def test_four_thousand_copies_of_pairs_of_words(spark):
    rng = random.Random(16)
    original = prose(77, 260)
    texts = [original, *edited_copies(rng, original, 4000, 14)]
    sets = [shingle_set(t, 2) for t in texts]
    alike = [len(sets[0] & s) / len(sets[0] | s) for s in sets[1:]]
    linked = {0, *(i for i, j in enumerate(alike, 1) if j >= 0.8)}
    assert len(linked) > 3000
    rows = [row(i, t) for i, t in enumerate(texts)]
    found = forest.near_duplicates(documents(spark, rows), 2).collect()
    assert {r.doc_id for r in found if r.component_id == 0} >= linked


@pytest.mark.parametrize("range_rows", [1, 7, 1000])
@pytest.mark.parametrize("nulls", [0, 3])
def test_fingerprints_against_the_plain_rule(spark, range_rows, nulls):
    rows = [row(i * 3, prose(i, i * 5) if i % 9 else None) for i in range(40)]
    rows += [row(30, prose(77, 40)), row(0, "a zero"), row(117, "b last"), row(-5, "negative one")]
    rows += [row(None, f"null {i}") for i in range(nulls)]
    found = merkle.fingerprints(documents(spark, rows), range_rows).collect()
    ordered = sorted(
        ((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1])
    )
    want = []
    for k, (doc_id, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        one, two = merkle.fingerprint(text), merkle.fingerprint(changed)
        near = merkle.likeness(one, two), merkle.likeness(one, merkle.fingerprint(following))
        want.append(
            (doc_id, len(text), sha256(changed.encode()).hexdigest(), one, two, *near)
        )
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_only_oversized_buckets_split(spark):
    rows = [row(i, prose(i, 20 + i % 60)) for i in range(300)]
    rows += [row(1000, "x" * 900)] * 7 + [row(None, prose(5, 30))] * 2 + [row(1001, "y" * 5000)]
    limit = 2000
    found = buckets.assign(documents(spark, rows), limit).collect()
    assert sorted(map(repr, [(r.doc_id, r.n_bytes) for r in found])) == sorted(
        repr((r[0], len(r[1].encode()))) for r in rows
    )
    sizes, full = defaultdict(int), defaultdict(int)
    for r in found:
        assert len(r.shard) == r.local_depth
        sizes[r.shard, r.page] += r.n_bytes
        for d in range(r.local_depth):
            full[r.shard[:d]] += r.n_bytes
    assert all(n <= limit or n == 5000 for n in sizes.values())
    assert all(n > limit for n in full.values())
    shards = sorted({r.shard for r in found})
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:], strict=False))
    assert len({r.shard for r in found if r.doc_id == 1000}) == 1


def test_shards_are_written_in_folders(spark, tmp_path):
    rows = [row(i, prose(i, 40)) for i in range(60)]
    buckets.write_shards(documents(spark, rows), 3000, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(60))
    sizes = back.groupBy("shard", "page").agg(F.sum(F.octet_length("text")).alias("n"))
    assert sizes.where("n > 3000").isEmpty() and sizes.count() > 3


def plain_budgets(tree, weights, total, name=""):
    """Hand out a budget in a nested dict of room, by repeated rounds of shares."""
    if not isinstance(tree, dict):
        return {name: min(total, tree)}

    def room(t):
        return sum(map(room, t.values())) if isinstance(t, dict) else t

    left, given = dict(tree), {}
    rest = min(total, room(tree))
    while left:
        rate = rest / sum(weights.get(f"{name}/{k}", 1) for k in left)
        full = [k for k in left if room(left[k]) <= rate * weights.get(f"{name}/{k}", 1)]
        if not full:
            given |= {k: rate * weights.get(f"{name}/{k}", 1) for k in left}
            break
        for k in full:
            given[k] = room(left.pop(k))
            rest -= given[k]
    out = {}
    for k, share in given.items():
        out |= plain_budgets(tree[k], weights, share, f"{name}/{k}")
    return out


def test_budgets_go_to_siblings_before_ancestors(spark):
    rng = random.Random(8)
    weights = {"/a": 5, "/a/x": 3, "/b": 2, "/a/x/1": 9, "/c/x/2": 4}
    tree = {
        d: {g: {str(s): 2 * rng.choice([10, 300, 4000, 90_000]) for s in range(4)} for g in "xyz"}
        for d in "abc"
    }
    leaves = [(d, g, s, n // 2) for d, t in tree.items() for g, u in t.items() for s, n in u.items()]
    frame = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    path = ["domain", "lang", "source"]
    for total in (0, 1000, 100_000, 600_000, 10**9):
        rows = mixing.budgets(frame, path, weights, total, 2).collect()
        want = plain_budgets(tree, weights, total)
        for r in rows:
            assert r.budget == pytest.approx(want[f"/{r.domain}/{r.lang}/{r.source}"], abs=4)
    with pytest.raises(ValueError):
        mixing.budgets(frame, path, {"/a": 0}, 10, 1)


def test_a_leaf_takes_whole_epochs_and_a_prefix(spark):
    rows = [(i, f"s{i % 2}", 5 + i % 11) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    sums = {s: sum(n for _, t, n in rows if t == s) for s in ("s0", "s1")}
    total = int(sums["s0"] * 2.5) + int(sums["s1"] * 0.5)
    found = mixing.mixed(
        docs, ["source"], {"/s0": 5, "/s1": 1}, total=total, max_epochs=3, seed=4
    ).collect()
    again = mixing.mixed(
        docs, ["source"], {"/s0": 5, "/s1": 1}, total=total, max_epochs=3, seed=4
    ).collect()
    assert sorted(found) == sorted(again)
    by = defaultdict(int)
    for r in found:
        by[r.source] += r.n_tokens
    assert 0 <= by["s0"] + by["s1"] - total + 2 <= 34
    epochs = {r.epoch for r in found if r.source == "s0"}
    assert epochs == {0, 1, 2}
    for epoch in (0, 1):
        assert len([r for r in found if r.source == "s0" and r.epoch == epoch]) == 200
    other = mixing.mixed(docs, ["source"], {}, total=500, seed=5).collect()
    assert {r.doc_id for r in other} != {r.doc_id for r in mixing.mixed(
        docs, ["source"], {}, total=500, seed=6).collect()}


RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "id": 1},
     [("user", "a"), ("assistant", "b")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]},
     [("user", "a"), ("assistant", "")]),
    ({"prompt": "p", "response": "[r]"}, [("user", "p"), ("assistant", "[r]")]),
    ({"completion": "c", "prompt": "[1, 2"}, [("user", "[1, 2"), ("assistant", "c")]),
    ({"instruction": "i", "input": "j", "output": "o"}, [("user", "i\n\nj"), ("assistant", "o")]),
    ({"instruction": "i", "input": "", "output": None}, [("user", "i"), ("assistant", "")]),
    ({"instruction": "i", "output": "o", "meta": {"x": 1}}, [("user", "i"), ("assistant", "o")]),
    ({"system": "s", "prompt": "p", "response": "r"},
     [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"other": 1}, None),
]


def test_layouts_are_chosen_by_the_fingerprint(spark):
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(RECORDS)] + [(97, None), (98, "no json")]
    frame = chat.record_turns(spark.createDataFrame(rows, "id long, record string"), "record")
    found = {r.id: r.turns for r in frame.collect()}
    for i, (_, want) in enumerate(RECORDS):
        assert (found[i] and [tuple(t) for t in found[i]]) == want
    assert found[97] is found[98] is None
    written = chat.formatted(frame.select("id", "turns")).where("turns is not null")
    read = written.select("turns", chat.read_back(F.col("formatted")).alias("back")).collect()
    assert len(read) == len(RECORDS) - 1
    assert all(r.turns == r.back for r in read)


def test_columns_without_a_layout_are_refused(spark):
    with pytest.raises(ValueError):
        chat.row_turns(spark.createDataFrame([(1, "x")], "conv_id long, text string"))


def test_copies_that_only_their_original_links(spark):
    rng = random.Random(6)
    original = prose(901, 300)
    texts = [original, *edited_copies(rng, original, 1000, 6)]
    sets = [shingle_set(t, 5) for t in texts]
    alike = [len(sets[0] & s) / len(sets[0] | s) for s in sets[1:]]
    assert min(alike) >= 0.8 and sum(
        len(sets[1] & s) / len(sets[1] | s) >= 0.8 for s in sets[2:]
    ) < 20
    rows = [row(i, t) for i, t in enumerate(texts)]
    found = forest.near_duplicates(documents(spark, rows), 5).collect()
    assert {r.component_id for r in found} == {0}


def test_candidates_of_the_first_look_alone_are_tried(spark, monkeypatch):
    texts = [prose(700 + i, 100) for i in range(10)]
    texts += edited_copies(random.Random(3), texts[0], 1, 2)
    shingles = forest.ShingleSets(2)
    ends = [xxhash.xxh3_64_intdigest(shingles(t)) for t in (texts[0], texts[-1])]
    x, y = sorted(n - (1 << 64) if n >> 63 else n for n in ends)

    def candidates(classes, second):
        one = classes.select(F.col("node").alias("a"), F.col("label").alias("la"))
        pairs = one.crossJoin(one.toDF("b", "lb")).where("a < b")
        true = (F.col("a") == x) & (F.col("b") == y)
        return pairs.select(
            "a", "b", "la", "lb", F.when(true, 60).otherwise(90).alias("agreeing")
        ).where(F.lit(not second))

    monkeypatch.setattr(forest, "candidates", candidates)
    rows = [row(i, t) for i, t in enumerate(texts)]
    found = forest.near_duplicates(documents(spark, rows), 2).collect()
    assert {r.doc_id: r.component_id for r in found} == {**{i: i for i in range(10)}, 10: 0}
