from __future__ import annotations

import pytest

from tests.llm.helpers import documents, empty, odd_documents, rows_of, with_clashing
from tests.oracle import connect, rows_of_spark, rows_of_sql
from tripmill.llm import linededup, queries


def test_query_against_sql(spark, data_dir):
    duck = connect(data_dir)
    got = rows_of_spark(queries.op2_line_dedup(spark, data_dir))
    assert got == rows_of_sql(duck, queries.LINES_SQL)


def spread(spark, sites):
    return [(100 + i, f"own line {i}\n  Accept cookies \nend {i}", "en", s) for i, s in enumerate(sites)]


@pytest.mark.parametrize("sites, removed", [("aaaabc", 0), ("abcd", 3), ("abcdee", 5)])
def test_counts_sites_not_rows(spark, sites, removed):
    docs = documents(spark, spread(spark, sites))
    got = linededup.without_spread_lines(docs, 4).orderBy("doc_id").collect()
    assert sum(row["n_removed"] for row in got) == removed
    assert got[0]["text"] == docs.first()["text"]
    assert all(row["n_chars"] == len(row["text"]) for row in got)
    if removed:
        assert got[1]["text"] == "own line 1\nend 1"


def test_sketch_far_above_the_threshold(spark):
    docs = documents(spark, spread(spark, [f"site{i}" for i in range(200)]))
    got = linededup.without_spread_lines(docs, 100).agg({"n_removed": "sum"}).first()[0]
    assert got == 199


def test_odd_rows(spark):
    docs = with_clashing(odd_documents(spark))
    got = linededup.without_spread_lines(docs, 2)
    assert set(got.columns) == set(docs.columns)
    rows = got.collect()
    assert len(rows) == docs.count()
    texts = {row["doc_id"]: row["text"] for row in rows if row["doc_id"]}
    assert texts[2] == "" and texts[4] is None and texts[1] != "" and texts[6] == " \n\t "


def test_null_source_is_one_site(spark):
    docs = documents(spark, spread(spark, [None, None, "a", "b"]))
    assert linededup.without_spread_lines(docs, 3).agg({"n_removed": "sum"}).first()[0] == 3


def test_empty_table(spark):
    assert rows_of(linededup.without_spread_lines(empty(spark))) == []
