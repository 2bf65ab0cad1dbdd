from __future__ import annotations

import hashlib
import re
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from quorumlake.llm import exact, jaccard, lines, suffix
from quorumlake.session import FREE_SHUFFLES, written

from .conftest import prose


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("seed", range(30))
def test_two_stage_sort_against_plain_sort(seed):
    random = np.random.default_rng(seed)
    depth = 8 * int(random.integers(1, 4))
    letters = ("ab", "a", "abcdefgh", "abz")[seed % 4]
    bodies = ["".join(random.choice(list(letters), random.integers(depth, 70))).encode() for _ in range(random.integers(1, 9))]
    bodies += bodies[:2]
    windows = np.array([len(b) - depth + 1 for b in bodies])
    times = random.integers(1, 3, len(bodies))
    counts = Counter()
    for body, n in zip(bodies, times, strict=True):
        for i in range(len(body) - depth + 1):
            counts[body[i : i + depth]] += int(n)
    found = exact.repeated(bodies, windows, times, depth)
    for body, got in zip(bodies, found, strict=True):
        assert got.tolist() == [i for i in range(len(body) - depth + 1) if counts[body[i : i + depth]] > 1]
    text = np.frombuffer(b"\0".join(b.translate(exact._UP) for b in bodies) + bytes(depth + 9), np.uint8)
    wanted = np.zeros(len(text), bool)
    at = 0
    for body, w in zip(bodies, windows, strict=True):
        wanted[at : at + w] = True
        at += len(body) + 1
    order = suffix.suffix_array(text, suffix.words(text), wanted, depth)
    shown = [text.tobytes()[i : i + depth] for i in order]
    assert shown == sorted(shown) and sorted(order) == np.flatnonzero(wanted).tolist()


def check_exact(docs, depth=exact.DEPTH):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    counts = Counter(d[i : i + depth] for _, d in rows for i in range(len(d) - depth + 1))
    expected = []
    for doc_id, data in rows:
        gone = bytearray(len(data))
        for i in range(len(data) - depth + 1):
            if counts[data[i : i + depth]] > 1:
                gone[i : i + depth] = b"\1" * depth
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        expected.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[4])
    assert sorted(map(tuple, exact.strip(docs, depth).collect()), key=key) == sorted(expected, key=key)


def test_passages_against_brute_force(awkward, clashing, nothing):
    check_exact(awkward.where("doc_id IS NULL OR doc_id NOT IN (112, 113)"))
    check_exact(awkward.where("doc_id > 80 AND doc_id <> 112").limit(100), depth=200)
    assert exact.strip(nothing).count() == 0
    assert exact.strip(clashing).count() == clashing.count()


def test_crowded_grams_go_window_by_window(awkward, monkeypatch):
    monkeypatch.setattr(exact, "CROWD", 1)
    check_exact(awkward.where("doc_id BETWEEN 85 AND 111"))


def test_windows_of_crowded_grams_never_meet_in_one_task(spark, monkeypatch):
    passage = prose(21, 80)
    docs = spark.createDataFrame([(k, f"{prose(300 + k, 8)} {passage} {prose(400 + k, 8)}") for k in range(40)], "doc_id long, text string")
    mark = exact._mark

    def guarded(depth):
        inner = mark(depth)

        def apply(frame):
            if len(frame) and frame["body"].value_counts().max() > 1:
                raise ValueError("equal bodies were not merged")
            return inner(frame)

        return apply

    monkeypatch.setattr(exact, "CROWD", 1)
    monkeypatch.setattr(exact, "_mark", guarded)
    check_exact(docs)


def word_sets(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = []
    for doc_id, text in rows:
        words = re.findall(r"(?:[a-z0-9_]|[^\x00-\x7f])+", (text or "").lower())
        n = min(5, len(words))
        out.append((doc_id, {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()))
    return out


def test_jaccard_against_brute_force(awkward, clashing, nothing):
    docs = awkward.where("doc_id IS NOT NULL AND doc_id <> 111")
    sets = word_sets(docs)
    near = {i: {j for j, b in sets if j != i and a and b and len(a & b) >= 0.8 * len(a | b)} for i, a in sets}
    got = {r["doc_id"]: r for r in jaccard.classes_of(docs).collect()}
    for i, others in near.items():
        reached, fresh = {i}, {i}
        while fresh:
            fresh = {k for j in fresh for k in near[j]} - reached
            reached |= fresh
        assert (got[i]["n_links"], got[i]["class_id"]) == (len(others), min(reached)), i
    assert jaccard.classes_of(nothing).count() == 0
    everything = jaccard.classes_of(clashing).collect()
    assert len(everything) == clashing.count()
    assert {r["n_links"] for r in everything if r["doc_id"] in (105, 106, 107)} == {0}
    kept = jaccard.thinned(clashing)
    assert kept.columns == clashing.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and not {102, 103, 104, 114} & set(ids) and {0, 3, 105, 106} <= set(ids)


def test_large_nodes_are_split_and_blocked(awkward, monkeypatch):
    docs = awkward.where("doc_id < 105")
    expected = {(r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.classes_of(docs).collect()}
    monkeypatch.setattr(jaccard, "SMALL", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.classes_of(docs).collect()} == expected


def test_banded_automaton_against_plain_distance():
    random = np.random.default_rng(3)
    pairs = []
    for _ in range(400):
        a = "".join(random.choice(list("ab"), random.integers(0, 30)))
        b = list(a)
        for _ in range(random.integers(0, 5)):
            k = int(random.integers(0, len(b) + 1))
            b[k : k + int(random.integers(0, 2))] = random.choice(list("abc"), random.integers(0, 2)).tolist()
        pairs.append(tuple(sorted((a, "".join(b)), key=len)))
    for tau in (1, 2, 3):
        got = lines.within([lines.code_points(a) for a, _ in pairs], [lines.code_points(b) for _, b in pairs], tau)
        assert got.tolist() == [distance(a, b) <= tau for a, b in pairs]


def check_lines(docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["text"]}
    first: dict[str, tuple] = {}
    for i in sorted(texts):
        for k, line in enumerate(texts[i].split("\n")):
            if len(line) >= lines.LEAST:
                first.setdefault(line, (i, k))
    near = {
        a for a in first for b in first
        if first[b] < first[a] and abs(len(a) - len(b)) <= 2 and (a[:8] == b[:8] or a[-8:] == b[-8:]) and len(a) < 5000 and distance(a, b) <= 2
    }
    got = {r["doc_id"]: r for r in lines.deduplicated(docs).collect()}
    for i, text in texts.items():
        gone = [k for k, x in enumerate(text.split("\n")) if len(x) >= lines.LEAST and (first[x] != (i, k) or x in near)]
        assert got[i]["removed"] == gone, i
    return near


def test_lines_against_brute_force(spark, awkward, clashing, nothing, monkeypatch):
    docs = awkward.where("doc_id IS NOT NULL AND doc_id NOT IN (111, 112)")
    assert check_lines(docs)
    line = prose(11, 12)
    variants = [line, line + "x", line[:-1], line[:20] + "zz" + line[22:], line[:10] + line[13:], line[:30] + "é" + line[30:]]
    family = spark.createDataFrame([(k, "\n".join([v, prose(200 + k, 9)])) for k, v in enumerate(variants)], "doc_id long, text string")
    assert check_lines(family)
    monkeypatch.setattr(lines, "BLOCK", 2)
    assert check_lines(family)
    assert lines.deduplicated(nothing).count() == 0
    rewritten = lines.rewritten(clashing)
    assert rewritten.columns == clashing.columns
    left = {r["doc_id"]: r["text"] for r in rewritten.collect()}
    assert not {102, 103, 104} & set(left) and {0, 3, 105, 106, 107, 110} <= set(left)
    assert prose(7, 60) in left[90] and prose(7, 60) not in left[91]


def test_short_lines_outlive_a_shared_footer(spark):
    footer = "printed by the city clerk of the town"
    texts = [f"{footer}\nheld", f"one leaf\n\nfalls\n{footer}", f"{footer}\n \t\n", footer]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in lines.rewritten(docs).collect()}
    assert left == {0: texts[0], 1: "one leaf\n\nfalls"}


def test_exact_repeats_of_short_lines_are_reported(spark):
    long = prose(31, 12)
    texts = ["share this\n" + long, "\u6211\u4eec\u5728\u8fd9\u91cc\u7b49\u5019\u3002", "share this", " \n\nshare this\nnew\nnew", None, "\u6211\u4eec\u5728\u8fd9\u91cc\u7b49\u5019\u3002\n \n" + long]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["removed"], r["short_repeats"]) for r in lines.deduplicated(docs).collect()}
    assert got == {0: ([], []), 1: ([], []), 2: ([], [0]), 3: ([], [2, 4]), 4: ([], []), 5: ([2], [0])}


@pytest.mark.parametrize("ids, kept", [((1, 5, 5, 7), "ABC"), ((5, 5, 5, 5), "ABC"), ((None, 5, 5, None), "ABC"), ((8, 5, 5, 7), "ABC")])
def test_texts_that_share_an_id_are_all_kept(spark, ids, kept):
    texts = {"A": prose(41, 80), "B": prose(42, 80), "C": prose(43, 80)}
    docs = spark.createDataFrame([(i, texts[x]) for i, x in zip(ids, "AABC", strict=True)], "doc_id long, text string")
    left = [r["text"] for r in jaccard.thinned(docs).collect()]
    assert sorted(left) == sorted(texts[x] for x in kept)


def test_lines_of_texts_that_share_an_id(spark):
    shared, a, b = prose(51, 12), prose(52, 12), prose(53, 12)

    def left(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        return sorted((r["doc_id"], r["text"]) for r in lines.rewritten(frame).collect())

    assert left([(1, f"{shared}\nshort"), (5, f"{a}\n{shared}"), (5, f"{b}\nshort")]) == sorted([(1, f"{shared}\nshort"), (5, a), (5, f"{b}\nshort")])
    assert left([(1, shared), (5, f"{a}\n{shared}"), (5, f"{shared}\n{b}")]) == sorted([(1, shared), (5, a), (5, b)])


def tables(spark):
    return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}


def test_met_lines_are_the_same_in_any_number_of_passes(spark, awkward, monkeypatch):
    found = []
    for passes in (1, 2, 4):
        monkeypatch.setattr(lines, "PASSES", passes)
        before = tables(spark)
        found.append(sorted(tuple(r) for r in lines.met_lines(awkward).collect()))
        assert len(tables(spark) - before) == passes
    assert found[0] and found[0] == found[1] == found[2]


@pytest.mark.parametrize(("thin", "result"), [(lines.rewritten, "removed-lines"), (jaccard.thinned, "near-classes")])
def test_only_tables_that_the_result_reads_stay(spark, awkward, thin, result):
    before = tables(spark)
    assert thin(awkward).count()
    left = {name[:-33] for name in tables(spark) - before}
    assert result in left
    assert left <= {"shared-ids", "sieve", result}


def test_written_leaves_no_shuffle_files(spark):
    folders = list(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString())

    def files():
        return {p for d in folders for p in Path(d).rglob("shuffle_*.data")}

    before = files()
    table = written(spark.range(5000).repartition(3, "id"), "dealt")
    until = time.time() + 5
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert table.count() == 5000
    assert spark.conf.get(FREE_SHUFFLES) == "false"
