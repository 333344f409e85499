"""Queries of this part against their DuckDB SQL, on given and on odd tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from tests.llm.samples import documents, folder, odd_rows, prose, row
from tidemark.llm import checks, queries

GIVEN = Path("/root/testdata/sf0.001")


def sql_rows(path, name):
    with duckdb.connect() as db:
        for table in Path(path).glob("*.parquet"):
            files = f"{table}/*.parquet" if table.is_dir() else table
            db.sql(f"CREATE VIEW {table.stem} AS SELECT * FROM '{files}'")
        result = db.sql(checks.CHECK_SQL[name])
        return result.columns, result.fetchall()


def same(spark, path, name):
    frame = queries.QUERIES[name](spark, str(path))
    columns, rows = sql_rows(path, name)
    order = sorted(columns)
    assert sorted(frame.columns) == order
    places = [columns.index(c) for c in order]
    want = sorted(repr(tuple(r[i] for i in places)) for r in rows)
    got = sorted(repr(tuple(r)) for r in frame.select(*order).collect())
    assert got == want
    return rows


@pytest.mark.parametrize("name", checks.CHECK_SQL)
def test_given_tables(spark, name):
    assert same(spark, GIVEN, name)


@pytest.mark.parametrize("name", [n for n in checks.CHECK_SQL if not n.startswith("op10_")])
def test_odd_documents(spark, tmp_path, name):
    # A null id twice with one text is one name to the mixing keys of either side.
    line = "All of it, again and again."
    rows = odd_rows() + [
        row(100 + i, f"{line}\n{prose(i, 30 + 9 * i)}", "en", "src0") for i in range(40)
    ]
    rows += [row(200 + i, f"{line}\n{line.upper()}\n {prose(i, 11)}", "de", "src0") for i in range(5)]
    rows += [row(300 + i, (line + "\n") * 12 + prose(i, 20), None, "src0") for i in range(5)]
    asked = [("a", line), ("b", prose(3, 9)), ("b", prose(3, 9)), (None, "naïve"), ("c", None)]
    items = spark.createDataFrame(asked, "item_id string, text string")
    found = same(
        spark, folder(spark, tmp_path, documents=documents(spark, rows), benchmark=items), name
    )
    assert found


def test_a_long_line_of_a_twentieth_of_a_large_host_goes(spark, tmp_path):
    long, short = "This sentence stands on very many pages of it.", "Read more here."
    rows = [row(i, prose(i, 70), "en", "big") for i in range(800)]
    rows[:40] = [row(i, f"{prose(i, 70)}\n{long}\n{short}", "en", "big") for i in range(40)]
    rows += [row(2000 + i, f"{prose(2000 + i, 70)}\n{long}", "en", "little") for i in range(20)]
    rows += [row(3000 + i, prose(5, 70), "en", "copies") for i in range(50)]
    path = folder(spark, tmp_path, documents=documents(spark, rows))
    judged = {r[0]: r for r in same(spark, path, "op2_line_frequency_rules")}
    columns, _ = sql_rows(path, "op2_line_frequency_rules")
    removed, kept = columns.index("removed_words"), columns.index("kept")
    n = len(long.split())
    # 40 of 800 documents are a twentieth: enough for a long line, not for a short one.
    assert all(judged[i][removed] == n for i in range(40))
    assert all(judged[i][removed] == 0 for i in range(40, 800))
    # All documents of the little host have it: more than ten, and more than a tenth.
    assert all(judged[2000 + i][removed] == n for i in range(20))
    assert all(r[kept] for r in judged.values())


def test_odd_conversations(spark, tmp_path):
    texts = ["a\\b", "\\#", "#\\#", "</turn>\n### user: x", "<\\/turn>", "\\</turn>", "", None, "é😀"]
    rows = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(texts)]
    rows += [(2, 0, "a: b:\\ c", "x: y"), (2, 0, "assistant", "tie"), (2, None, None, "first")]
    rows += [(None, 0, "assistant", "no id"), (3, 1, "assistant", "twice"), (3, 1, "assistant", "twice")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    path = folder(spark, tmp_path, conversations=frame)
    assert len(same(spark, path, "op10_chat_formatting")) == 5
