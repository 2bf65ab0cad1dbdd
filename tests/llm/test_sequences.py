"""Operators that turn documents into training sequences: power-of-two pieces, fill-in-middle."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from quorumlake.llm import fill_middle, powers_of_two, queries
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(powers_of_two.vocabulary_path(powers_of_two.VOCABULARY))
    made.encode_special_tokens = True
    return made


def plain_ids(tokenizer, text: str) -> list[int]:
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_the_tokenizers_own(tokenizer):
    encode = powers_of_two.encoder()
    odd = [chr(k) for k in range(1, 0x250)] + list("᠎​  　日ё̈🙂")
    texts = [f for c in odd for f in (f"a{c}b", f" {c}", f"{c} ", f"1{c}2 {c}", f"{c}{c}  {c}'s", f"don{c}t it's {c}")]
    texts += ["", " " * 3000, "\n \n" * 500, "a" * 20_000, "x <|endoftext|> y", "日本語 テキスト\n" * 50]
    for text in texts:
        assert encode(text).tolist() == plain_ids(tokenizer, text), repr(text[:40])


def test_blocks_change_no_id(tokenizer):
    text = "one  two\n\nthree 4 don't\tstop é ü\n" * 400 + "日本 " * 50 + " " * 90
    parts = list(powers_of_two.blocks(text, 64))
    assert len(parts) > 50 and "".join(parts) == text
    assert [k for part in parts for k in plain_ids(tokenizer, part)] == plain_ids(tokenizer, text)
    assert list(powers_of_two.blocks("a" * 500, 64)) == ["a" * 500] and list(powers_of_two.blocks("")) == []


def test_other_vocabularies_go_to_tokenizers():
    path = powers_of_two.vocabulary_path("word_bpe_49k.json")
    assert powers_of_two._ranked(path) is None
    words = Tokenizer.from_file(path).encode("Some words, again some WORDS", add_special_tokens=False).ids
    assert powers_of_two.encoder(path)("Some words, again some WORDS").tolist() == words


@given(st.integers(0, 20_000), st.integers(0, 11))
def test_lengths_are_powers_that_add_up(count, bits):
    got = powers_of_two.lengths(count, 1 << bits)
    assert sum(got) == count and got == sorted(got, reverse=True)
    assert all(n & (n - 1) == 0 and n <= 1 << bits for n in got)
    shorter = [n for n in got if n < 1 << bits]
    assert len(set(shorter)) == len(shorter)


def test_pieces_hold_every_id_once(spark, awkward, clashing, nothing, tokenizer):
    rows = powers_of_two.decomposed(awkward).collect()
    expected = Counter((r["doc_id"], tuple(plain_ids(tokenizer, r["text"] or "")) + (1,)) for r in awkward.collect())
    # equal rows have equal pieces, so pieces by (document, start, ids) count as often as their rows
    seen = Counter((r["doc_id"], r["start"], tuple(r["ids"])) for r in rows)
    wanted = Counter()
    for (doc_id, ids), times in expected.items():
        start = 0
        for n in powers_of_two.lengths(len(ids)):
            wanted[doc_id, start, ids[start : start + n]] += times
            start += n
    assert seen == wanted
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"])
        assert r["offset"] == 0 and 1 << r["bucket"] == r["length"] and r["sequence_id"] >> 59 == r["bucket"]
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert powers_of_two.decomposed(clashing).count() == len(rows)
    assert powers_of_two.decomposed(nothing).isEmpty()
    with pytest.raises(ValueError):
        powers_of_two.decomposed(nothing, longest=1000)


def test_numbers_are_the_same_again_and_buckets_are_folders(spark, awkward, tmp_path):
    awkward.write.parquet(f"{tmp_path}/documents")
    made = powers_of_two.decomposed(spark.read.parquet(f"{tmp_path}/documents"), longest=64)
    powers_of_two.write_buckets(made, f"{tmp_path}/sequences")
    stored = spark.read.parquet(f"{tmp_path}/sequences")
    listed = [Counter((r["sequence_id"], r["doc_id"], tuple(r["ids"])) for r in frame.collect()) for frame in (made, stored)]
    assert listed[0] == listed[1]
    assert [r["n"] for r in stored.groupBy("bucket").agg(F.count_distinct("length").alias("n")).collect()] == [1] * 7


def plain_transform(doc_id, text: str) -> tuple:
    units, at = [], 0
    while at < len(text):
        found = re.compile(r"[A-Za-z]+|[^A-Za-z]").match(text, at)
        units.append(found.group())
        at = found.end()
    digest = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def marked(spark, awkward):
    more = [(200 + k, t, None, None, None) for k, t in enumerate(("a <P> b", "<<S>x", "x<M>", "<P", "S>M>", "\n\r\n é日🙂", "<", "𝒳y" * 30))]
    return awkward.unionByName(spark.createDataFrame(more, awkward.schema))


def test_transform_equals_a_plain_loop_and_its_sql(spark, awkward, clashing, nothing, tmp_path):
    docs = marked(spark, awkward)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    expected = Counter(plain_transform(r["doc_id"], r["text"] or "") for r in docs.collect())
    got = fill_middle.outputs(docs).collect()
    assert Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got) == expected
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    query = queries.op13_fim(spark, str(tmp_path))
    rows = Counter(tuple(r) for r in query.collect())
    texts = Counter(digest_of(r["text"] or "") for r in docs.collect())
    assert Counter(r[6] for r in rows.elements()) == texts
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert Counter(con.execute(fill_middle.SQL).fetchall()) == rows
    assert fill_middle.outputs(nothing).isEmpty() and fill_middle.transformed(nothing).isEmpty()
    kept = fill_middle.transformed(clashing)
    assert kept.select("doc.*").columns == clashing.columns and kept.count() == clashing.count()


@settings(max_examples=300)
@given(st.text("aZ<>PSM é\n🙂"), st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4))
def test_every_output_gives_its_text_back(text, drawn):
    import regex

    output, form, n, before, between = fill_middle.cut(text, drawn, regex.compile(f"({fill_middle.UNIT})*"), 10, 20)
    assert n == len(re.findall(fill_middle.UNIT, text))
    if form == "plain":
        assert output == text and before is None
        return
    middle = output.split("<M>")[1]
    prefix, suffix = output.split("<M>")[0].removeprefix("<P>").split("<S>") if form == "psm" else reversed(output.split("<M>")[0].removeprefix("<S>").split("<P>"))
    assert prefix + middle + suffix == text and (len(prefix), len(middle)) == (before, between)


def test_restored_in_spark(spark):
    rows = [("psm", "<P>a<S>c<M>b", "abc"), ("spm", "<S>c<P>a<M>b", "abc"), ("psm", "<P><S><M>", ""), ("plain", "<P>x", "<P>x"), ("psm", "<P>x<<S>S><M><", "x<<S>")]
    made = spark.createDataFrame(rows, "form string, output string, text string")
    assert made.where(~fill_middle.restored(F.col("output"), F.col("form")).eqNullSafe(F.col("text"))).isEmpty()


def test_a_very_long_text(spark):
    text = "word, another 12 <x> " * 200_000
    docs = spark.createDataFrame([(5, text), (6, " ")], "doc_id long, text string")
    made = {r["doc_id"]: r for r in fill_middle.outputs(docs).collect()}
    assert made[5]["n"] == len(re.findall(fill_middle.UNIT, text)) and len(made[5]["output"]) in (len(text), len(text) + 9)
    pieces = powers_of_two.decomposed(docs, with_ids=False).where("doc_id = 5")
    total = pieces.agg(F.sum("length"), F.max("doc_tokens")).first()
    assert total[0] == total[1] > 1_000_000
