from __future__ import annotations

import shutil
from collections import defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.samples import documents, folder, odd_rows, prose, row
from tidemark.llm import frames, packing, queries
from tidemark.llm.memory import Recent
from tidemark.llm.shared import sized_batches
from tidemark.llm.tokens import WordEncoder, word_encoder


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.TOKENIZER)


def whole(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def digest(ids):
    return crc32(np.array(ids, "<u4").tobytes())


def test_words_have_the_ids_of_the_whole_text(tokenizer):
    texts = [r[1] for r in odd_rows()] + [
        "can't I'LL 'sx''s \x1cb\xa0c 12３ ½ é k ＡＢ ǅ Σας", "a" * 3000, "ﬁ ª º × ÷ ÿ Ÿ ß ẞ",
    ]
    for keep in (10_000, 3):
        encoder = WordEncoder(queries.TOKENIZER, keep)
        for text in texts:
            ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
            assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_of_letters_are_remembered_once():
    encoder = WordEncoder(queries.TOKENIZER, 10_000)
    text = "river Étude, étude river's rivers"
    first = encoder.encode(text)
    words = {w.encode() for w in text.split()} | {"étude".encode()}
    assert set(encoder._words) == words and set(encoder._pieces) == {",", "'s"}
    assert encoder.encode(text) == first


def test_texts_coded_together_have_the_ids_of_each(tokenizer):
    texts = [None, *(r[1] for r in odd_rows()), "", " \x0b\x1c ", "a\x85b\xa0c\x1fd e\0 \0. É\u0301", 
        "  Étude...  étude' l'été! 'sx''s x<|endoftext|> <pad> a<b. 12. ***a a*** ÿ, ß× ｶ。 Ÿ",
    ]
    for keep in (10_000, 3):
        encoder = WordEncoder(queries.TOKENIZER, keep)
        for column in (
            pa.array(texts), pa.array(texts).slice(2), pa.array(texts, pa.large_string()),
            pa.array(["", None], pa.string()), pa.array([], pa.string()),
        ):
            found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_all(column)]
            assert found == [
                tokenizer.encode(text or "", add_special_tokens=False).ids
                for text in column.to_pylist()
            ]


def test_words_of_texts_coded_together_are_cut_once(monkeypatch):
    encoder = WordEncoder(queries.TOKENIZER, 10_000)
    cut = []
    monkeypatch.setattr(encoder, "_piece", lambda p, piece=encoder._piece: cut.append(p) or piece(p))
    monkeypatch.setattr(encoder, "_pieces", Recent(encoder._piece, 10_000))
    texts = ["river Étude, étude... RIVER river. 2024", None, "River, rivers étude, river's 2024"]
    first = encoder.encode_all(pa.array(texts))
    kept = {"river", "rivers", "étude", "river's", "2024", ""}
    assert set(encoder._words) == {word.encode() for word in kept}
    once = ["river", "rivers", "étude", "'s", "2", "0", "4", ",", ".", "..."]
    assert sorted(cut) == sorted(once)
    assert encoder.encode_all(pa.array(texts)) == first == list(map(encoder.encode, texts))
    assert sorted(cut) == sorted(once)


def test_texts_are_sliced_by_their_bytes():
    texts = ["é" * 6, None, "", "b" * 30, "c", "d" * 7, "e"]
    batch = pa.RecordBatch.from_pydict({"n": list(range(7)), "text": texts})
    found = [b.column("n").to_pylist() for b in sized_batches([batch, batch[:0]], "text", 10)]
    assert found == [[0], [1, 2, 3], [4, 5], [6], []]


def test_the_words_of_the_pipeline_go_with_the_task(spark, tmp_path, monkeypatch):
    path = shutil.copy(queries.TOKENIZER, tmp_path / "own.json")
    monkeypatch.setattr(queries, "TOKENIZER", str(path))
    docs = documents(spark, [row(i, prose(i, 50)) for i in range(80)]).repartition(8)

    def words(batches):
        kept = word_encoder(str(path))._words
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(kept)] * batch.num_rows)], ["n"])

    def kept():
        return spark.range(80).repartition(8).mapInArrow(words, "n long").agg({"n": "max"}).first()[0]

    left = corpus_pipeline.sequence_packing(spark, docs, "")
    left = sorted(map(repr, left.collect()))
    assert len(left) == 80 and kept() == 0
    assert sorted(map(repr, queries.packed(docs).collect())) == left and kept() > 0


def test_all_pieces_of_all_documents_are_packed_without_gaps(spark, tmp_path, tokenizer):
    rows = odd_rows() + [row(100 + i, prose(i, 40 + 37 * i % 900)) for i in range(150)]
    sf_dir = folder(spark, tmp_path, documents=documents(spark, rows))
    placed = queries.op1_best_fit_packing(spark, sf_dir).collect()
    expected = []
    for doc_id, text, *_ in rows:
        ids = whole(tokenizer, text, queries.PACKED_END)
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected.append((doc_id, piece, at, len(part), digest(part)))
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    sequences = defaultdict(list)
    for r in placed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    least = -(-sum(e[3] for e in expected) // 4096)
    assert len(sequences) <= least + 2


def test_the_sum_of_squares_rule_picks_the_smallest_change():
    rng = np.random.default_rng(5)
    sizes = np.concatenate([rng.integers(1, 21, 300), [20, 20, 1]])
    bins, offsets = packing.sum_of_squares(sizes, 20)
    gaps: dict[int, int] = {}
    for size, chosen, offset in zip(sizes.tolist(), bins.tolist(), offsets.tolist(), strict=True):
        def squares(g):
            counts = defaultdict(int)
            for gap in [*(v for k, v in gaps.items() if k != g), gaps[g] - size]:
                counts[gap] += gap > 0
            return sum(n * n for n in counts.values())

        fitting = [g for g, gap in gaps.items() if gap >= size]
        if fitting:
            assert squares(chosen) == min(map(squares, fitting))
        else:
            assert chosen not in gaps
        assert offset == 20 - gaps.get(chosen, 20)
        gaps[chosen] = gaps.get(chosen, 20) - size


def test_packed_sequences_hold_the_ids(spark, tokenizer):
    rows = [row(i, prose(i, 60 + 11 * i)) for i in range(30)]
    pieces = packing.token_pieces(documents(spark, rows), queries.TOKENIZER, 1, 512)
    found = packing.sequences(packing.place(pieces, 512, 2)).collect()
    got = sorted(i for r in found for i in r.ids)
    assert got == sorted(i for r in rows for i in whole(tokenizer, r[1], 1))
    assert max(len(r.ids) for r in found) <= 512


def test_token_files_read_back_in_order(spark, tmp_path, tokenizer):
    rows = odd_rows() + [row(500 - i, prose(i, 50)) for i in range(40)]
    sf_dir = folder(spark, tmp_path, documents=documents(spark, rows))
    found = queries.op8_seekable_token_files(spark, sf_dir).collect()
    expected = sorted(
        repr((d, len(ids), digest(ids)))
        for d, ids in ((r[0], whole(tokenizer, r[1], queries.FILE_END)) for r in rows)
    )
    assert sorted(repr((r.doc_id, r.n_tokens, r.ids_crc32)) for r in found) == expected
    at, before = 0, None
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        assert before is None or before <= r.doc_id
        before = r.doc_id


def test_a_reader_opens_only_the_frames_it_needs(spark, tmp_path, tokenizer, monkeypatch):
    rows = [row(i, prose(i, 50)) for i in range(60)]
    files = frames.write_token_files(
        documents(spark, rows), queries.TOKENIZER, 2, str(tmp_path / "files"), frame_tokens=500
    )
    chosen = frames.read_token_files(files, [7, 31, 1000]).collect()
    assert sorted(r.doc_id for r in chosen) == [7, 31]
    starts = {r.doc_id: r.start for r in frames.read_token_files(files).collect()}
    for r in chosen:
        assert np.frombuffer(r.ids, "<u4").tolist() == whole(tokenizer, rows[r.doc_id][1], 2)
        assert r.start == starts[r.doc_id]
    opened = []
    path = files.first().path
    with frames._filesystem(path)[0].open_input_file(path) as source:
        reader = frames.FrameReader(source)
        plain = reader.frame
        monkeypatch.setattr(reader, "frame", lambda k: opened.append(k) or plain(k))
        first = files.orderBy("file_no").first()
        assert first.path == path
        assert [d for d, _ in reader.find({3})] == [3]
    assert len(reader.seek) > len(opened) == 1


def test_small_files_share_a_list_and_a_reading_task(spark, tmp_path, tokenizer, monkeypatch):
    rows = odd_rows() + [row(100 + i, prose(i, 50)) for i in range(80)]
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        files = frames.write_token_files(
            documents(spark, rows), queries.TOKENIZER, 2, str(tmp_path / "files")
        )
    finally:
        spark.conf.unset(setting)
    written = files.collect()
    assert len(written) > 4 and len(files.inputFiles()) == 1
    read = []
    for tokens, tasks in ((1, len(written)), (1 << 30, 1)):
        monkeypatch.setattr(frames, "READ_TOKENS", tokens)
        found = frames.read_token_files(files).withColumn("task", F.spark_partition_id()).collect()
        assert len({r.task for r in found}) == tasks
        assert [r.start for r in found] == sorted(r.start for r in found)
        read.append(sorted(repr((r.doc_id, r.start, r.n_tokens, r.ids)) for r in found))
        ids = b"".join(r.ids for r in sorted(found, key=lambda r: r.start))
        assert len(ids) == 4 * sum(f.tokens for f in written)
    assert read[0] == read[1] and len(read[0]) == len(rows)


def test_a_damaged_frame_is_noticed(tmp_path):
    path = tmp_path / "x"
    with open(path, "wb") as out:
        writer = frames.FrameWriter(out, 4)
        for i in range(8):
            writer.add(i, bytes([i, 0, 0, 0]) * 3)
        writer.close()
    system, inner = frames._filesystem(str(path))
    with system.open_input_file(inner) as source:
        reader = frames.FrameReader(source)
        assert [d for k in range(len(reader.seek)) for d, _ in reader.frame(k)] == list(range(8))
        reader.seek[1] = (*reader.seek[1][:2], reader.seek[1][2] ^ 1)
        with pytest.raises(ValueError):
            reader.frame(1)
