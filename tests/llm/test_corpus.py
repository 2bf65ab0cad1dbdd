from __future__ import annotations

import math
import os

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from quorumlake.llm import jaccard, mixing, neighbours, packing, queries
from quorumlake.session import shared_dir

from .conftest import SCHEMA, rows

SF = "/root/testdata/sf0.001"


def stored(spark) -> list[str]:
    return os.listdir(shared_dir(spark).removeprefix("file:"))


def test_mix_equals_its_sql(awkward, clashing, nothing):
    con = duckdb.connect()
    con.register("frame", awkward.toPandas())
    con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, * EXCLUDE doc_id FROM frame")
    key = lambda r: str(r)
    expected = sorted(con.execute(mixing.SQL).fetchall(), key=key)
    got = sorted((tuple(r) for r in mixing.mix(awkward).collect()), key=key)
    assert len(got) == len(expected)
    for a, b in zip(got, expected, strict=True):
        assert a == pytest.approx(b)
    assert mixing.mix(nothing).count() == 0 and mixing.emit(nothing).count() == 0
    emitted = mixing.emit(clashing)
    assert emitted.columns == clashing.columns
    assert emitted.count() == sum(r["copies"] for r in mixing.mix(clashing).collect())


@pytest.mark.parametrize("doc_id", [None, 7])
def test_documents_under_one_id_are_drawn_one_by_one(spark, doc_id):
    rows = [(doc_id, f"a b c {k} e f g h i j", "one") for k in range(6000)] + [(k, f"x {k} y", "two") for k in range(14_000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for size in {r["source_size"] for r in got}:
        mine = [r for r in got if r["source_size"] == size]
        assert sum(r["taken"] for r in mine) == pytest.approx(mine[0]["target"], rel=0.04)


def test_targets_share_everything_under_the_cap(spark):
    sizes = {"a": 10, "b": 1000, "c": 3, "d": 500, None: 40, "e": 0}
    got = {r["source"]: r for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    assert sum(r["target"] for r in got.values()) == pytest.approx(sum(sizes.values()))
    assert all(r["target"] <= 3 * r["source_size"] + 1e-9 for r in got.values())
    weights = dict(zip(["a", "b", "c", "d", "e", None], [1, 2, 3, 1, 2, 3], strict=True))
    level = {s: r["target"] / weights[s] for s, r in got.items() if r["target"] < 3 * r["source_size"] - 1e-9}
    assert max(level.values()) == pytest.approx(min(level.values()))


def test_every_word_is_packed_once(awkward, clashing, nothing):
    got = packing.pack(awkward).toPandas()
    assert packing.pack(nothing).count() == 0 and packing.pack(clashing).count() == len(got)
    words = sum(len((r["text"] or "").split()) for r in awkward.collect())
    assert got["length"].sum() == words
    bins = got.dropna(subset=["bin"]).groupby("bin").agg(used=("length", "sum"), capacity=("capacity", "first"), kinds=("capacity", "nunique"))
    assert (bins["used"] <= bins["capacity"]).all() and (bins["kinds"] == 1).all() and set(bins["capacity"]) <= set(packing.CAPACITIES)
    for _, part in got.dropna(subset=["bin"]).groupby("bin"):
        ends = part.sort_values("bin_offset")
        assert (ends["bin_offset"].to_numpy()[1:] == (ends["bin_offset"] + ends["length"]).to_numpy()[:-1]).all()


def test_best_fit_wastes_little_and_downsizes():
    lengths = sorted(np.random.default_rng(1).integers(1, 4097, 3000).tolist(), reverse=True)
    bins, _, sizes = packing.best_fit(lengths)
    used = np.bincount(bins, lengths)
    assert sum(lengths) >= 0.97 * sum(sizes)
    for u, s in zip(used, sizes, strict=True):
        assert s == min(c for c in packing.CAPACITIES if c >= u)


def test_pigeonhole_meets_every_code_in_radius():
    random = np.random.default_rng(5)
    codes = random.integers(0, 1 << 16, (300, 4)).astype(np.uint16)
    codes[1:50] = codes[0] ^ (np.uint16(1) << random.integers(0, 16, (49, 4)).astype(np.uint16))
    block = neighbours.Block(codes)
    for radius in (0, 3, 4, 9, 20, 31):
        assert (block.within(codes[:20], radius) == (block.distances(codes[:20]) <= radius)).all()


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_neighbours_recall_and_awkward_vectors(spark):
    random = np.random.default_rng(9)
    x = random.normal(size=(1500, 16)).astype(np.float32)
    x[40] = x[41]
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    bad = [(2000, None, 0), (2020, [0.0] * 16, 0), (2040, [float("nan")] * 16, 0), (2060, [None] * 16, 0), (2080, [float("inf")] * 16, 0), (None, [1.0] * 16, 0), (2100, [1.0], 0), (2120, [], 0)]
    got = neighbours.nearest(vectors(spark, rows + bad + rows[:3])).collect()
    truth = list(neighbours.brute_force(np.arange(1500), x.astype(np.float64)))
    assert len(got) == len(truth)
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert sum((q, v) in found for q, _, v, _ in truth) >= 0.9 * len(truth)
    for r in got:
        assert math.isclose(r["score"], float((x[r["query_id"]].astype(float) * x[r["vec_id"]].astype(float)).sum()), rel_tol=1e-12)
    few = neighbours.nearest(vectors(spark, rows[:4])).collect()
    assert [(r["query_id"], r["rank"]) for r in few] == [(0, 1), (0, 2), (0, 3)]
    assert neighbours.nearest(vectors(spark, [])).count() == 0


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    truth = {(q, v) for q, _, v, _ in neighbours.brute_force(table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float))}
    got = {(r["query_id"], r["vec_id"]) for r in queries.op8_neighbours(spark, SF).collect()}
    assert len(truth & got) >= 0.9 * len(truth)


def test_stages_keep_columns_and_take_awkward_rows(spark, awkward, clashing, nothing, tmp_path):
    for docs in (awkward, clashing, nothing):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{id(docs)}-{name}"
            out = stage(spark, docs, SF)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns, name
            out.write.parquet(path)
            docs = spark.read.parquet(path)


def test_pipeline_keeps_one_of_each_group(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    before = set(stored(spark))
    ids = [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()]
    assert not {102, 103, 104, 105, 106, 107, 108} & set(ids)
    # of all tables written on the way only the stages' results are left
    left = {name.rsplit("-", 1)[0] for name in set(stored(spark)) - before}
    assert left == {name for name, _ in corpus_pipeline.STAGES}


def test_pipeline_stages_leave_whole_copies_and_no_fragments(spark):
    """Copies that differ in one line: the first stage keeps them whole, the next keeps one."""
    from .conftest import prose

    base = [prose(900 + j, 40) for j in range(12)]
    texts = {k: "\n".join([*base[:k], prose(990 + k, 3), *base[k + 1 :]]) for k in range(5)}
    texts |= {10: prose(1, 60) + "\n" + prose(2, 60), 11: prose(3, 60) + "\n" + base[0]}
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()], SCHEMA)
    after = corpus_pipeline.line_dedup(spark, docs, SF)
    left = {r["doc_id"]: r["text"] for r in after.collect()}
    assert {k: left[k] for k in range(5)} == {k: texts[k] for k in range(5)}
    assert left[10] == texts[10] and left[11] == prose(3, 60)
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.near_duplicates(spark, after, SF).collect()}
    assert kept == {0: texts[0], 10: texts[10], 11: prose(3, 60)}


def test_crowded_groups_get_their_size(spark):
    groups = spark.range(40).selectExpr("IF(id < 30, 1, id) AS node", "id AS key")
    found = {r["node"]: r["n"] for r in jaccard.with_crowds(groups, "node", 20).collect()}
    assert found == {1: 30} | dict.fromkeys(range(30, 40), 1)
    assert {r["n"] for r in jaccard.with_crowds(groups, "node", 30).collect()} == {1}
    assert jaccard.with_crowds(groups.where("key < 0"), "node", 1).isEmpty()


def test_documents_without_an_id_share_the_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 10)
    docs = spark.createDataFrame([(None, "one two three")] * 60, "doc_id long, text string")
    packed = packing.pack(docs).collect()
    assert len(packed) == 60 and len({r["bin"] >> 24 for r in packed}) > 1


def test_queries_over_the_given_tables(spark):
    count = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, query in queries.QUERIES.items():
        if name not in ("op6_packing", "op8_neighbours", "op11_powers", "op12_variants"):
            assert query(spark, SF).count() == count, name
