"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import pytest
from compare import connect, difference, type_difference

from quorumlake import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
WINDOW_PER_KEY = ("best_per_key", "latest_per_group", "insert_if_absent", "rows_as_map", "prefer_format")


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, small, connection, name):
    frame = QUERIES[name](spark, small)
    plan = plan_of(frame)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        assert difference(frame, connection, SQL[name]) is None
        assert type_difference(frame, connection, SQL[name]) is None
    else:
        assert frame.count() > 0


@pytest.mark.parametrize("name", WINDOW_PER_KEY)
def test_one_row_per_key_is_limited_before_the_shuffle(spark, small, name):
    assert plan_of(QUERIES[name](spark, small)).count("WindowGroupLimit") >= 2


def test_filters_and_columns_reach_the_scan(spark, small):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(QUERIES["filter_conjunction"](spark, small))
    assert "GreaterThan(l_quantity,30.0)" in plan and "EqualTo(l_returnflag,R)" in plan
    assert "l_extendedprice" not in plan
    assert "TakeOrderedAndProject" in plan_of(QUERIES["sort_limit"](spark, small))


def test_spans_move_no_rows(spark, small):
    from quorumlake.operators.spans import all_spans

    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert "Exchange" not in plan_of(all_spans(docs, "doc_id"))


def test_upsert_index_keeps_the_id_of_each_entry(spark, small):
    from hashlib import sha256

    assert "AS entry_id" in SQL["upsert_index"]
    row = QUERIES["upsert_index"](spark, small).first()
    assert row["entry_id"] == sha256(f"indexed_event_term\1{row['term']}\1{row['doc_id']}".encode()).hexdigest()


def test_upsert_index_moves_texts_and_no_counts(spark, tmp_path):
    docs = [(1, "ore bike"), (1, "ore"), (2, "ore ore"), (3, "bike"), (None, "lost ore"), (4, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(1, 1), (2, 0), (2, 1), (3, 2), (None, 1), (9, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    frame = QUERIES["upsert_index"](spark, str(tmp_path))
    moved = [line for line in plan_of(frame).split("\n") if "Exchange hashpartitioning" in line]
    assert moved and not any("term" in line for line in moved)
    got = sorted((r.term, r.doc_id or 0, r.value, r.updated.month) for r in frame.collect())
    assert got == [
        ("bike", 1, 2.5, 2), ("bike", 3, 1.0, 1), ("lost", 0, 1.0, 1), ("ore", 0, 1.0, 1), ("ore", 1, 5.0, 2), ("ore", 2, 5.0, 2), ("ore2", 2, 2.0, 2),
    ]


def test_postings_map_moves_texts_and_nothing_else(spark, tmp_path):
    docs = [(1, "ore bike"), (999, "ore"), (1000, "ore ore")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    frame = QUERIES["postings_map"](spark, str(tmp_path))
    assert plan_of(frame).count("Exchange") == 1
    assert sorted(map(tuple, frame.collect())) == [("bike", 0, "1:1"), ("ore", 0, "1:1,999:1"), ("ore", 1, "1000:2")]
