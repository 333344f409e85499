"""Every operator and stage on odd rows, empty tables and clashing column names."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.samples import EXTRA, documents, folder, odd_rows, prose, row, with_extra
from tidemark.llm import queries

DOCUMENT_QUERIES = [n for n in queries.QUERIES if not n.startswith(("op10_", "op12_"))]
PER_ROW = [
    "op2_line_frequency_rules", "op3_backoff_automaton", "op4_lsh_forest",
    "op6_quadratic_discriminant", "op7_extendible_hashing", "op8_seekable_token_files",
    "op9_merkle_fingerprints", "op11_prefix_byte_pairs",
]
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    labels = [(1, 1, 0), (2, 0, 0), (None, 1, 0), (6, None, 0), (8, 0, 0), (8, 1, 0), (10, 1, None)]
    made = {}
    for name, docs in (
        ("odd", documents(spark, odd_rows())),
        ("extra", with_extra(documents(spark, odd_rows()))),
        ("empty", documents(spark, [])),
        ("nulls", documents(spark, [(None,) * 5] * 3)),
    ):
        path = tmp_path_factory.mktemp(name)
        rows = [] if name == "empty" else labels
        made[name] = folder(
            spark, path, documents=docs, labels=spark.createDataFrame(rows, LABELS)
        )
    return made


def rows_of(frame) -> list[str]:
    return sorted(map(repr, frame.drop("sequence_id", "offset").collect()))


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_odd_rows_have_a_result_that_extra_columns_leave_alone(spark, tables, name):
    query = queries.QUERIES[name]
    plain = rows_of(query(spark, tables["odd"]))
    assert plain == rows_of(query(spark, tables["extra"]))
    if name in PER_ROW:
        assert len(plain) == len(odd_rows())


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_empty_tables_give_no_rows_and_null_rows_do_no_harm(spark, tables, name):
    query = queries.QUERIES[name]
    empty = query(spark, tables["empty"])
    assert empty.collect() == []
    nulls = query(spark, tables["nulls"])
    assert nulls.schema.names == empty.schema.names
    if name in PER_ROW or name.startswith("op1_"):
        assert nulls.count() == 3


@pytest.mark.parametrize("kind", ["odd", "extra", "empty", "nulls"])
@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_rows(spark, tables, kind, stage):
    docs = spark.read.parquet(f"{tables[kind]}/documents.parquet")
    _, function = corpus_pipeline.STAGES[stage]
    result = function(spark, docs, tables[kind])
    given, found = docs.count(), result.collect()
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert result.columns == docs.columns
        assert len(found) <= given
        if kind == "extra":
            assert all(r[name] == name for r in found for name in EXTRA)
    if kind == "empty":
        assert not found


def test_the_pipeline_keeps_one_of_each_group_and_packs_the_rest(spark, tmp_path):
    good = [row(i, prose(100 + i, 150), source=f"src{i % 4}") for i in range(60)]
    copies = [row(100 + i, good[i][1]) for i in range(10)]
    bad = [row(200 + i, "JUNK!! " + "WORSE!! " * 90) for i in range(12)]
    labels = [(r[0], 1, 0) for r in good + copies] + [(r[0], 0, 0) for r in bad]
    sf_dir = folder(
        spark, tmp_path, documents=documents(spark, good + copies + bad),
        labels=spark.createDataFrame(labels, LABELS),
    )
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, sf_dir)
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert kept[0] == kept[1] == {r[0] for r in good + copies}
    assert kept[2] == {r[0] for r in good}
    assert 0.6 * 60 <= len(kept[3]) < 60
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in packed} == kept[3]
