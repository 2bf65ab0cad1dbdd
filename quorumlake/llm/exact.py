"""Removal of repeated passages: every byte of a string of DEPTH bytes that also starts elsewhere.

Equal strings must meet before suffixes can be sorted, and only those. Each
window of DEPTH bytes names one of its k-grams, the one of least hash, and
neighbouring windows that name the same one form a region. Equal windows name
equal k-grams, so suffix arrays over the regions of one k-gram see all repeats.
Regions whose k-gram stands nowhere else are dropped by hash; equal regions are
merged into one with a multiplicity. The rest, distinct regions only, is dealt
by k-gram into buckets of bounded size; each bucket is sorted by the two-stage
suffix sort and marked where adjacent common prefixes reach DEPTH. Of a k-gram with
more regions than a bucket holds the windows are counted instead, by two hashes
beside the k-gram's own, before anything meets in one task; no bytes move for
them, and a window counted more than once is repeated.

Texts are shuffled only for documents that hold something repeated.

Defined cases: a null text counts as empty; repeated rows are repeats of each
other; texts shorter than DEPTH keep all bytes; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import pieces, record_batch, schema_of, sieve, sifted
from .hashing import grams, mix, prefix, spans
from .suffix import common_prefixes, suffix_array, words

DEPTH = 200
GRAM = 16
#: windows of one pass; longer texts go in passes that overlap
PASS = 1 << 23
BUCKET_BYTES = 1_500_000
#: distinct regions of one k-gram that one bucket may hold
CROWD = 32_768
_POSITION = np.uint64((1 << 24) - 1)
_UP = bytes((i + 1) % 256 for i in range(256))
#: bytes under another name, for a second hash
_TURNED = mix(np.arange(256, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)


def regions(data: bytes, depth: int = DEPTH) -> tuple[np.ndarray, ...]:
    """(k-gram hash, region hash, first window, number of windows) of every region."""
    found = []
    for low in range(0, max(1, len(data) - depth + 1), PASS):
        part = np.frombuffer(data, np.uint8)[low : low + PASS + depth - 1]
        if len(part) >= depth:
            found.append(_regions(part, low, depth))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _regions(part: np.ndarray, low: int, depth: int) -> tuple[np.ndarray, ...]:
    sums = prefix(part)
    hashed = grams(sums, GRAM)
    place = np.arange(len(hashed), dtype=np.uint64)
    # the rightmost of equal hashes is least
    least = (hashed & ~_POSITION) | (_POSITION - place)
    width, done = depth - GRAM + 1, 1
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if width > done:
        least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
    chosen = (_POSITION - (least & _POSITION)).astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    count = np.diff(np.append(start, len(chosen)))
    body = spans(sums, start, start + count + depth - 1)
    return hashed[chosen[start]].view(np.int64), body.view(np.int64), start + low, count


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, th, data): a document is known by its id and a hash of its text."""
    doc_id = F.col("doc_id").cast("long")
    data = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(-1)).alias("rid"), F.xxhash64("text").alias("th"), data.alias("data"))


def _anchored(docs: DataFrame, depth: int) -> DataFrame:
    schema = "rid long, th long, h long, rh long, start int, windows int"
    target = schema_of(docs.sparkSession, schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                columns: list[list[np.ndarray]] = [[] for _ in range(6)]
                for rid, th, data in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    h, rh, start, windows = regions(data, depth)
                    for column, x in zip(columns, (np.full(len(h), rid), np.full(len(h), th), h, rh, start, windows), strict=True):
                        column.append(x)
                yield record_batch([pa.array(np.concatenate(c)) for c in columns], target)

    return _keyed(docs).select("rid", "th", "data").mapInArrow(apply, schema)


CUT = "h long, rh long, windows int, n long, body binary"


def _cut(rows: DataFrame, depth: int) -> DataFrame:
    """Bytes of the regions a document stands for."""
    target = schema_of(rows.sparkSession, CUT)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                out = []
                for data, held in zip(piece.column("data").to_pylist(), piece.column("held").to_pylist(), strict=True):
                    for r in held:
                        start, count = r["start"], r["windows"]
                        out.append((r["h"], r["rh"], count, r["n"], data[start : start + count + depth - 1]))
                for at in range(0, len(out), 20_000):
                    yield record_batch([list(c) for c in zip(*out[at : at + 20_000], strict=True)], target)

    return rows.mapInArrow(apply, CUT)


WINDOWS = "h long, rh long, off int, n long, w long, w2 long"


def _windows(rows: DataFrame, depth: int) -> DataFrame:
    """Two hashes of every window of the regions a document stands for."""
    target = schema_of(rows.sparkSession, WINDOWS)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                for data, held in zip(piece.column("data").to_pylist(), piece.column("held").to_pylist(), strict=True):
                    for low in range(0, len(held), 500):
                        columns: list[list[np.ndarray]] = [[] for _ in range(6)]
                        for r in held[low : low + 500]:
                            start, count = r["start"], r["windows"]
                            part = np.frombuffer(data, np.uint8)[start : start + count + depth - 1]
                            at = np.arange(count)
                            made = (
                                *(np.full(count, r[name]) for name in ("h", "rh")), at, np.full(count, r["n"]),
                                *(spans(prefix(x), at, at + depth).view(np.int64) for x in (part, _TURNED[part])),
                            )
                            for column, x in zip(columns, made, strict=True):
                                column.append(x)
                        yield record_batch([pa.array(np.concatenate(c)) for c in columns], target)

    return rows.mapInArrow(apply, WINDOWS)


def _runs(rows: DataFrame, depth: int) -> DataFrame:
    """(h, rh, low, high) of every window that stands more than once, from rows of _windows."""
    windows = written(rows, "windows")
    # summed before the shuffle, so that a window brings one row a task however many regions share it
    often = windows.groupBy("h", "w", "w2").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
    low = F.col("off").cast("long")
    return windows.join(often, ["h", "w", "w2"]).select("h", "rh", low.alias("low"), (low + depth).alias("high"))


def repeated(bodies: list[bytes], windows: np.ndarray, times: np.ndarray, depth: int) -> list[np.ndarray]:
    """Of each region the window offsets that occur more than once, by suffix array and common prefixes."""
    lengths = windows + depth
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    text = np.frombuffer(b"\0".join(b.translate(_UP) for b in bodies) + bytes(depth + 9), np.uint8)
    edge = np.zeros(len(text) + 1, np.int32)
    edge[starts] += 1
    edge[starts + windows] -= 1
    wanted = np.cumsum(edge[:-1]) > 0
    word = words(text)
    order = suffix_array(text, word, wanted, depth)
    equal = common_prefixes(word, order, depth) >= depth
    twice = equal.copy()
    twice[:-1] |= equal[1:]
    marked = np.zeros(len(text), bool)
    marked[order[twice]] = True
    # a region that stands for several has its copies' suffixes as neighbours
    copied = np.repeat(times > 1, lengths)
    marked[: len(copied)] |= copied & wanted[: len(copied)]
    return [np.flatnonzero(marked[s : s + w]) for s, w in zip(starts, windows, strict=True)]


def _mark(depth: int):
    def apply(frame: pd.DataFrame) -> pd.DataFrame:
        offsets = repeated(frame["body"].tolist(), frame["windows"].to_numpy(np.int64), frame["n"].to_numpy(), depth)
        h, rh, low, high = [], [], [], []
        for key, body, found in zip(frame["h"], frame["rh"], offsets, strict=True):
            if len(found):
                breaks = np.flatnonzero(np.diff(found) > 1)
                for a, b in zip(found[np.append(0, breaks + 1)], found[np.append(breaks, len(found) - 1)], strict=True):
                    h.append(key)
                    rh.append(body)
                    low.append(a)
                    high.append(b + depth)
        return pd.DataFrame({"h": h, "rh": rh, "low": low, "high": high}).astype("int64")

    return apply


def covered(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(rid, th, marks): the repeated byte ranges of each document that has any, not merged."""
    anchors = written(_anchored(docs, depth), "anchors")
    often = anchors.groupBy("h").count().where("count > 1")
    thin = sifted(anchors, "h", sieve(often, "h"))
    merged = thin.groupBy("h", "rh", "windows").agg(
        F.count("*").alias("n"), F.min(F.struct("rid", "th", "start")).alias("first")
    )
    merged = written(merged.select("h", "rh", "windows", "n", "first.*"), "regions")
    crowds = merged.groupBy("h").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    live = written(
        merged.join(crowds, "h").select("h", "rh", "windows", "n", "rid", "th", "start", (F.col("kinds") > CROWD).alias("crowded")),
        "live-regions",
    )
    size = F.when(~F.col("crowded"), F.col("windows") + depth)
    total, crowded = live.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.bool_or("crowded"), F.lit(False))).first()
    buckets = max(1, math.ceil(total / BUCKET_BYTES))

    def holding(rows: DataFrame) -> DataFrame:
        held = rows.groupBy("rid", "th").agg(F.collect_list(F.struct("h", "rh", "windows", "n", "start")).alias("held"))
        return sifted(_keyed(docs), "rid", sieve(rows, "rid")).join(held, ["rid", "th"]).select("data", "held")

    marks = (
        _cut(holding(live.where(~F.col("crowded"))), depth)
        .groupBy(F.pmod(F.xxhash64("h"), F.lit(buckets)).alias("bucket"))
        .applyInPandas(_mark(depth), "h long, rh long, low long, high long")
    )
    if crowded:
        marks = marks.unionByName(_runs(_windows(holding(live.where("crowded")), depth), depth))
    marks = marks.groupBy("h", "rh").agg(F.collect_set(F.struct("low", "high")).alias("marks"))
    marks = written(marks, "marks")
    hits = thin.join(marks, ["h", "rh"]).select(
        "rid", "th", F.transform("marks", lambda m: F.struct((m["low"] + F.col("start")).alias("low"), (m["high"] + F.col("start")).alias("high"))).alias("marks")
    )
    # a set: rows that repeat a document bring the same marks
    return hits.groupBy("rid", "th").agg(F.flatten(F.collect_set("marks")).alias("marks"))


def merged_ranges(marks: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted((m["low"], m["high"]) for m in marks):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(high, out[-1][1])
        else:
            out.append((low, high))
    return out


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def strip(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Bytes, removed bytes, removed runs and digest of what is kept, for every document."""
    ranges = written(covered(docs, depth), "ranges")
    target = schema_of(docs.sparkSession, RESULT)
    rows = _keyed(docs)
    held = sieve(ranges, "rid")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                out = []
                many = piece.column("marks").to_pylist() if "marks" in piece.schema.names else [None] * piece.num_rows
                for doc_id, data, marks in zip(piece.column("doc_id").to_pylist(), piece.column("data").to_pylist(), many, strict=True):
                    gone = merged_ranges(marks or [])
                    kept, at = hashlib.sha256(), 0
                    for low, high in gone:
                        kept.update(data[at:low])
                        at = high
                    kept.update(data[at:])
                    out.append((doc_id, len(data), sum(b - a for a, b in gone), len(gone), kept.hexdigest()))
                if out:
                    yield record_batch([list(c) for c in zip(*out, strict=True)], target)

    clean = sifted(rows, "rid", held, inside=False).select("doc_id", "data").mapInArrow(apply, RESULT)
    touched = sifted(rows, "rid", held).join(ranges, ["rid", "th"], "left").select("doc_id", "data", "marks")
    return clean.unionByName(touched.mapInArrow(apply, RESULT))
