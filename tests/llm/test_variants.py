"""Spelling variants against brute force: counts, neighbours, forms and roots."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
from quorumlake.llm import queries, variants

from .conftest import SCHEMA


def plain_counts(rows, typo_every=None) -> dict[str, int]:
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]+", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{word}".encode())
            if typo_every and h % typo_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= variants.LEAST_LETTERS:
                found[word] += 1
    return {w: n for w, n in found.items() if n >= variants.LEAST_COUNT}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def plain_groups(counts: dict[str, int]) -> set[tuple]:
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= variants.RATIO * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return out


def words_of(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def test_groups_equal_brute_force(spark):
    random = np.random.default_rng(11)
    counts = {}
    for size in (5, 6, 7, 8):
        for _ in range(220):
            counts["".join(random.choice(list("abà"), size))] = int(random.choice([3, 4, 6, 12, 24, 50]))
    assert {tuple(r) for r in variants.grouped(words_of(spark, counts)).collect()} == plain_groups(counts)


def test_runs_of_one_letter_and_shared_prefixes(spark):
    counts = {"a" * k: 3 * k for k in range(5, 24)}
    counts |= {"a" * k + "b": 5 for k in range(5, 24, 3)} | {"zebra": 9, "zebras": 30, "ébra": 3, "zébra": 3, "zzebra": 3}
    assert {tuple(r) for r in variants.grouped(words_of(spark, counts)).collect()} == plain_groups(counts)


def test_words_beyond_the_levels(spark):
    random = np.random.default_rng(12)
    counts = {}
    for size in (63, 64, 65, 66, 400, 20_000):
        base = "".join(random.choice(list("abcdefgh"), size))
        edits = [base]
        for at in (0, size // 2 - 1, size // 2, size // 2 + 1, size - 1):
            edits += [base[:at] + base[at + 1 :], base[:at] + "z" + base[at:], base[:at] + "y" + base[at + 1 :], base[:at] + "x" + base[at + 1 :]]
        counts |= {w: 3 + k for k, w in enumerate(edits)}
    assert {tuple(r) for r in variants.grouped(words_of(spark, counts)).collect()} == plain_groups(counts)


def test_documents_equal_a_plain_loop_and_sql(spark, awkward, clashing, nothing, tmp_path):
    more = [
        (k, "Straße GARTEN Garten gärten ÄRGER ärger GÄRTEN×÷ naïve naive Naïve-naive colour color Colour COLOR colours", None, None, None)
        for k in range(300, 700)
    ]
    docs = awkward.unionByName(spark.createDataFrame([*more, (None, "colours garden " * 3, None, None, None)], SCHEMA))
    expected = plain_counts([(r["doc_id"], r["text"]) for r in docs.collect()], variants.TYPO_EVERY)
    assert {tuple(r) for r in variants.word_counts(docs, typo_every=variants.TYPO_EVERY).collect()} == set(expected.items())
    plain = plain_counts([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {tuple(r) for r in variants.word_counts(docs).collect()} == set(plain.items())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries.op12_variants(spark, str(tmp_path)).collect()}
    assert got == plain_groups(expected) and any(r[1] for r in got)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert set(con.execute(variants.SQL).fetchall()) == got
    assert variants.word_counts(clashing).count() == variants.word_counts(awkward).count()
    assert variants.grouped(variants.word_counts(nothing)).isEmpty()


def test_chains_end_at_the_root(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "ccccc": 5}
    got = {r["word"]: r for r in variants.grouped(words_of(spark, counts)).collect()}
    assert {r["root"] for w, r in got.items() if w != "ccccc"} == {"bbbbb"} and got["ccccc"]["root"] == "ccccc"
    assert got["aaaaa"]["form"] == "aaaab" and got["bbbbb"]["form"] is None
