"""Order MinHash fingerprints of documents.

Every k-mer of code points is numbered by its occurrence in the text. One hash
of (k-mer, occurrence) deals them into SKETCHES bins; of each bin the L
smallest are taken, put back into text order, and hashed as a tuple. A bin with
fewer takes what its successors hold, round the circle. Two texts agree in a
sketch only if they share those k-mers in that order, so the share of equal
sketches falls with edit distance and not just with set overlap.

Defined cases: a null text counts as empty; a text shorter than k is one
k-mer; the empty text has a fingerprint of its own that is like nothing but
itself; ties are broken by text position. Rows are chained in order of
doc_id, nulls last, equal ids by a hash of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import map_rows
from .hashing import code_points, grams, mix, prefix

K = 8
L = 2
BIN_BITS = 6
SKETCHES = 1 << BIN_BITS
HEX = 4
PER_BIN = 16
_OCCURRENCE = np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64(0xA0761D6478BD642F)
SHIFT = np.uint64(64 - BIN_BITS)


def numbered(text: np.ndarray, k: int = K) -> np.ndarray:
    """A hash of (k-mer, occurrence number) at every position."""
    if not len(text):
        return np.zeros(0, np.uint64)
    sums = prefix(text)
    keys = grams(sums, min(k, len(text)))
    bits = np.uint64(max(20, int(len(keys)).bit_length()))
    place = (np.uint64(1) << bits) - np.uint64(1)
    order = (keys & ~place) | np.arange(len(keys), dtype=np.uint64)
    order.sort()
    same = (order[1:] >> bits) == (order[:-1] >> bits)
    again = np.flatnonzero(same) + 1
    if len(again):
        # occurrence number: distance to the start of the run of equal k-mers
        first = np.arange(len(order))
        first[again] = 0
        np.maximum.accumulate(first, out=first)
        times = (again - first[again]).astype(np.uint64)
        at = (order[again] & place).astype(np.int64)
        keys[at] = mix(keys[at] + times * _OCCURRENCE)
    return keys


def fingerprint(text: np.ndarray, k: int = K) -> np.ndarray:
    """SKETCHES tuple hashes (uint16) of a text of code points."""
    keys = numbered(text, k)
    if not len(keys):
        return np.zeros(SKETCHES, np.uint16)
    # a bin's smallest keys have small low parts: look at a share of all keys first, at all if that fails
    share = SKETCHES * PER_BIN / len(keys)
    chosen = None
    if share < 0.5:
        limit = np.uint64(int(share * float(1 << (64 - BIN_BITS))))
        low = keys & ((np.uint64(1) << SHIFT) - np.uint64(1))
        chosen = np.flatnonzero(low < limit)
        if np.bincount((keys[chosen] >> SHIFT).astype(np.int64), minlength=SKETCHES).min() < L:
            chosen = None
    at = np.arange(len(keys)) if chosen is None else chosen
    order = at[np.argsort(keys[at], kind="stable")]
    ranked = keys[order]
    starts = np.searchsorted(ranked >> SHIFT, np.arange(SKETCHES, dtype=np.uint64))
    picks = (starts[:, None] + np.arange(L)) % len(order)
    places = np.sort(order[picks], axis=1)
    out = np.full(SKETCHES, 0x2545F4914F6CDD1D, np.uint64)
    for j in range(L):
        out = mix(out * _PLACE + keys[places[:, j]])
    # the top bits, never zero: zero stands for the empty text
    return ((out >> np.uint64(48)).astype(np.uint16)) | np.uint16(1)


def as_string(sketch: np.ndarray) -> str:
    return sketch.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The L-th root of the share of equal sketches: about the texts' Jaccard similarity, order kept."""
    return float((a == b).mean() ** (1 / L))


def compared(text: str, following: str) -> tuple:
    """(n_chars, sha256 of the edited text, both fingerprints, likeness to edited and next)."""
    mine = code_points(text)
    theirs = code_points(following)
    return _compared(text, mine, fingerprint(mine), following, fingerprint(theirs))


def _compared(text: str, mine: np.ndarray, own: np.ndarray, following: str, theirs: np.ndarray) -> tuple:
    half = len(mine) // 2
    edited = text[: len(text) - half] + following[:half]
    other = fingerprint(code_points(edited))
    return (
        len(mine),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        as_string(own),
        as_string(other),
        likeness(own, other),
        likeness(own, theirs),
    )


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
#: part and edge (head or tail of a partition, with its text) besides the results
CHAINED = RESULT + ", part int, edge string, text string"


def _chain(rows: Iterator[tuple]) -> Iterator[list]:
    """Results of every row but the partition's last, and the first and last rows as edges."""
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    held = None
    for doc_id, text in rows:
        text = text or ""
        points = code_points(text)
        own = fingerprint(points)
        if held is None:
            out.append((doc_id, *[None] * 6, part, "head", text))
        else:
            out.append((held[0], *_compared(held[1], held[2], held[3], text, own), None, None, None))
        held = (doc_id, text, points, own)
        if len(out) >= 2000:
            yield [list(c) for c in zip(*out, strict=True)]
            out = []
    if held is not None:
        out.append((held[0], *[None] * 6, part, "tail", held[1]))
        yield [list(c) for c in zip(*out, strict=True)]


def _join_edges(rows: Iterator[tuple]) -> Iterator[list]:
    for doc_id, text, following in rows:
        yield [[x] for x in (doc_id, *compared(text, following))]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, and its likeness to its edited text and to the next document.

    Texts move once, into ranges of doc_id. What a range needs of its
    neighbour is one document, which is joined to it afterwards.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # no text in the range key: a sample of the keys goes to the driver
    order = (F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    chained = written(map_rows(ordered, _chain, CHAINED), "fingerprints")
    heads = chained.where("edge = 'head'").select("part", F.col("text").alias("following"))
    # one row per partition that has rows, without its text
    parts = heads.select("part")
    after = Window.orderBy("part")
    turns = parts.select(
        "part", F.coalesce(F.lead("part").over(after), F.min("part").over(Window.partitionBy())).alias("next_part")
    )
    tails = chained.where("edge = 'tail'").select("part", "doc_id", "text")
    seams = tails.join(turns, "part").join(heads.withColumnRenamed("part", "next_part"), "next_part")
    ends = map_rows(seams.select("doc_id", "text", "following"), _join_edges, RESULT)
    return chained.where("edge IS NULL").drop("part", "edge", "text").unionByName(ends)
