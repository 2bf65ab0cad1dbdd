"""Near-duplicate lines by a segment-partition edit join.

A line is cut into TAU + 1 segments. Two lines within TAU edits share a segment
of the shorter one, at nearly the same place; so every line puts its segments
into an index keyed by its length, and looks up, for each length it may meet,
only the substrings that a match could align there. Lines that meet under a key
are verified by a banded bit-parallel automaton, many pairs at a time. A line
goes if an equal or near line stands earlier (by document, then line number).

Keys move once; texts move only for lines that met another. Crowded keys are
dealt out in pairs of blocks.

Lines under LEAST characters take no part in the edit join; exact repeats of
those that are not blank are found with the others and reported.

Defined cases: lines under LEAST characters always stay; white space makes a
line blank and blank lines count nowhere; a null text has no lines; documents with equal doc_id count as one; ties in
order go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written, written_alone
from .common import pieces, record_batch, rid, schema_of, sieve, sifted, told_apart
from .hashing import code_points, mix, prefix, spans
from .jaccard import bucket_of, in_cells, with_crowds

TAU = 2
#: a share of the text; the rest is what copies share at the similarity of near copies
FRAGMENT = 0.2
LEAST = 20
BLOCK = 512
#: a power of two
PASSES = 2
LINE_BREAK = 10
#: the white space of \s in Spark's patterns
BLANKS = np.array([9, 10, 11, 12, 13, 32], np.uint32)
CELLS = 2_000_000
NOTHING = np.uint32(0xFFFFFFFF)


class Lines:
    """The lines of several texts as spans of one array of code points."""

    def __init__(self, rids: list[int], texts: list[str]) -> None:
        self.points = code_points("\n".join(texts) + "\n")
        self.end = np.flatnonzero(self.points == LINE_BREAK)
        self.start = np.concatenate([[0], self.end[:-1] + 1])
        counts = np.array([t.count("\n") + 1 for t in texts], np.int64)
        self.rid = np.repeat(np.array(rids, np.int64), counts)
        first = np.repeat(np.cumsum(counts) - counts, counts)
        self.number = np.arange(len(self.end)) - first
        self.sums = prefix(self.points)
        self.length = self.end - self.start
        self.hash = spans(self.sums, self.start, self.end)
        self.eligible = self.length >= LEAST
        inked = np.concatenate([[0], np.cumsum(~np.isin(self.points, BLANKS))])
        self.filled = self.eligible | (inked[self.end] > inked[self.start])

    def firsts(self, among: np.ndarray) -> np.ndarray:
        """Of each distinct line among the marked ones the earliest here."""
        rows = np.flatnonzero(among)
        order = rows[np.lexsort((self.number[rows], self.rid[rows], self.hash[rows]))]
        hashed = self.hash[order]
        return order[np.concatenate([[True], hashed[1:] != hashed[:-1]])] if len(order) else order

    def second(self, rows: np.ndarray) -> np.ndarray:
        """A further hash of the lines, so that 128 bits name one."""
        turned = prefix(mix(self.points.astype(np.uint64)) & np.uint64(0xFFFFFFFF))
        return spans(turned, self.start[rows], self.end[rows])


def identity(hashed: np.ndarray) -> np.ndarray:
    """63 bits that name a line where lines meet; the sign is free."""
    return (hashed >> np.uint64(1)).view(np.int64)


def segment(length: np.ndarray, k: int, tau: int = TAU) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment k of lines of a length; the last ones are longer by one."""
    size, longer = length // (tau + 1), length % (tau + 1)
    late = np.maximum(0, k - (tau + 1 - longer))
    return k * size + late, size + (k >= tau + 1 - longer)


def keys(lines: Lines, rows: np.ndarray, tau: int = TAU) -> tuple[np.ndarray, np.ndarray]:
    """(key, id) rows; the id is negative (~id) where the row is also in the index."""
    out_keys, out_ids = [], []
    start, length = lines.start[rows], lines.length[rows]
    ids = identity(lines.hash[rows])
    for shorter in range(tau + 1):
        other = length - shorter
        for k in range(tau + 1):
            at, size = segment(other, k, tau)
            low = max(-k, shorter - (tau - k))
            high = min(k, shorter + (tau - k))
            for shift in range(low, high + 1):
                place = at + shift
                fits = (place >= 0) & (place + size <= length) & (other > 0)
                begin = start[fits] + place[fits]
                hashed = spans(lines.sums, begin, begin + size[fits])
                tag = mix(other[fits].astype(np.uint64) * np.uint64(tau + 1) + np.uint64(k))
                out_keys.append(mix(hashed ^ tag).view(np.int64))
                out_ids.append(~ids[fits] if shorter == 0 and shift == 0 else ids[fits])
    return np.concatenate(out_keys), np.concatenate(out_ids)


def _per_piece(docs: DataFrame, schema: str, columns, least: int = LEAST) -> DataFrame:
    """mapInArrow that hands each piece's lines to `columns` and yields its column arrays; texts under `least` characters are left out."""
    target = schema_of(docs.sparkSession, schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                lines = Lines(piece.column("rid").to_pylist(), piece.column("text").to_pylist())
                made = columns(lines)
                for at in range(0, len(made[0]), 100_000):
                    part = [c[at : at + 100_000] for c in made]
                    yield record_batch([pa.array(c) if isinstance(c, np.ndarray) else c for c in part], target)

    texts = docs.where(F.length("text") >= least).select(rid().alias("rid"), "text")
    return texts.mapInArrow(apply, schema)


def _firsts(held: np.ndarray):
    """Each piece's distinct lines with the place of the earliest; the text only of those that may have met another."""

    def columns(lines: Lines) -> list:
        rows = lines.firsts(lines.filled)
        h = lines.hash[rows]
        bit = (mix(identity(h).view(np.uint64)) & np.uint64(len(held) * 32 - 1)).astype(np.int64)
        met = ((held[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1).astype(bool) & lines.eligible[rows]
        spans_ = zip(met, lines.start[rows], lines.end[rows], strict=True)
        body = [lines.points[a:b].tobytes() if m else None for m, a, b in spans_]
        return [h.view(np.int64), lines.second(rows).view(np.int64), lines.rid[rows], lines.number[rows].astype(np.int32), body]

    return columns


def met_rows(batches: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, id, indexed) of keys that an index row and another line share.

    The batches come sorted by key and tagged id, index rows first, so the first
    row of a key tells whether the key is indexed at all; it is given out once a
    second line shows up, and no key is ever held whole.
    """
    last_key, first_id, open_, given = None, 0, False, False
    for key, tagged in batches:
        if not len(key):
            continue
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        fresh[0] = last_key is None or key[0] != last_key
        # a row in front stands for the key left open by the batch before
        starts = np.flatnonzero(fresh)
        run = np.cumsum(fresh)
        ids = np.where(tagged < 0, ~tagged, tagged)
        run_key = np.concatenate([[0 if last_key is None else last_key], key[starts]])
        run_id = np.concatenate([[first_id], ids[starts]])
        run_open = np.concatenate([[open_], tagged[starts] < 0])
        other = run_open[run] & (ids != run_id[run])
        # repeated rows stand side by side
        again = np.zeros(len(key), bool)
        again[1:] = (key[1:] == key[:-1]) & (tagged[1:] == tagged[:-1])
        other &= ~again
        shown = np.zeros(len(run_id), bool)
        shown[run[other]] = True
        lead = shown.copy()
        lead[0] &= not given
        yield (
            np.concatenate([run_key[lead], key[other]]),
            np.concatenate([run_id[lead], ids[other]]),
            np.concatenate([np.ones(lead.sum(), bool), tagged[other] < 0]),
        )
        given = bool(shown[-1] or (len(run_id) == 1 and given))
        last_key, first_id, open_ = key[-1], run_id[-1], run_open[-1]


def _line_sieve(met: DataFrame, bits: int = 23) -> np.ndarray:
    """A bit set of fixed size (1 MB) over mixed line ids."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(1 << (bits - 5), np.uint32)
        for batch in batches:
            bit = (mix(batch.column("key").to_numpy().view(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.int64)
            np.bitwise_or.at(words, bit >> 5, np.uint32(1) << (bit & 31).astype(np.uint32))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used].astype(np.int64))], ["w", "v"])

    got = met.select("key").mapInArrow(apply, "w long, v long").groupBy("w").agg(F.expr("bit_or(v)").alias("v")).toArrow()
    held = np.zeros(1 << (bits - 5), np.uint32)
    held[got["w"].to_numpy()] = got["v"].to_numpy().astype(np.uint32)
    return held


def within(a: list[np.ndarray], b: list[np.ndarray], tau: int = TAU) -> np.ndarray:
    """Whether the edit distance of each pair is at most tau; a is never longer than b.

    State e holds one bit per diagonal of the band: set where the prefixes there
    agree up to e edits. A step reads one symbol of each a; match, substitution
    and deletion carry bits on, insertion shifts them within the step.
    """
    size = np.array([len(x) for x in a])
    gap = np.array([len(x) for x in b]) - size
    out = np.zeros(len(a), bool)
    alive = np.flatnonzero((gap >= 0) & (gap <= tau))
    if not len(alive):
        return out
    longest = int(size[alive].max())
    top = np.full((longest, len(alive)), NOTHING, np.uint32)
    side = np.full((longest + 2 * tau + 1, len(alive)), NOTHING - np.uint32(1), np.uint32)
    for k, row in enumerate(alive):
        top[: size[row], k] = a[row]
        side[tau : tau + len(b[row]), k] = b[row]
    width = 2 * tau + 1
    full = np.uint16((1 << width) - 1)
    state = []
    for e in range(tau + 1):
        # nothing read: e insertions reach e diagonals above the main one
        state.append(np.full(len(alive), sum(1 << (tau + d) for d in range(e + 1)) & int(full), np.uint16))
    ends = size[alive]
    for step in range(longest + 1):
        done = ends == step
        if done.any():
            bit = (np.uint16(1) << (tau + gap[alive[done]]).astype(np.uint16)).astype(np.uint16)
            out[alive[done]] = (state[tau][done] & bit) > 0
        if step == longest:
            break
        if step % 32 == 31 or done.any():
            keep = (ends > step) & (state[tau] > 0)
            if not keep.all():
                alive, ends = alive[keep], ends[keep]
                top, side = top[:, keep], side[:, keep]
                state = [s[keep] for s in state]
                if not len(alive):
                    break
        match = np.zeros(len(alive), np.uint16)
        for d in range(width):
            match |= (top[step] == side[step + d]).astype(np.uint16) << np.uint16(d)
        fresh = [state[0] & match]
        for e in range(1, tau + 1):
            below = state[e - 1]
            fresh.append(((state[e] & match) | below | (below >> np.uint16(1)) | (fresh[e - 1] << np.uint16(1))) & full)
        state = fresh
    return out


def _verify(tau: int):
    def apply(frame: pd.DataFrame) -> pd.DataFrame:
        ids = frame["key"].to_numpy(np.int64)
        unique, place = np.unique(ids, return_inverse=True)
        first = np.unique(ids, return_index=True)[1]
        bodies = [np.frombuffer(x, np.uint32) for x in frame["body"].to_numpy()[first]]
        size = np.array([len(x) for x in bodies])
        rids, numbers = frame["rid"].to_numpy(np.int64)[first], frame["number"].to_numpy(np.int64)[first]
        indexed, own = frame["indexed"].to_numpy(bool), frame["own"].to_numpy(np.int64)
        low, high = frame["low"].to_numpy(np.int64), frame["high"].to_numpy(np.int64)
        found = []
        for rows in frame.groupby(["meet", "low", "high"], sort=False).indices.values():
            i, j = np.triu_indices(len(rows), 1)
            i, j = rows[i], rows[j]
            # within one block all pairs, between two blocks the pairs across
            good = (indexed[i] | indexed[j]) & (place[i] != place[j]) & ((low[i] == high[i]) | (own[i] != own[j]))
            found.append(np.stack([place[i[good]], place[j[good]]]))
        pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        swap = size[pairs[0]] > size[pairs[1]]
        a, b = np.where(swap, pairs[1], pairs[0]), np.where(swap, pairs[0], pairs[1])
        even = (size[a] == size[b]) & (a > b)
        a, b = np.where(even, b, a), np.where(even, a, b)
        near = size[b] - size[a] <= tau
        both = np.unique(a[near] * len(unique) + b[near])
        a, b = both // max(1, len(unique)), both % max(1, len(unique))
        order = np.argsort(size[b], kind="stable")
        a, b = a[order], b[order]
        later = []
        at = 0
        while at < len(a):
            # pairs of like length together, as many as fit
            step = max(1, min(20_000, CELLS // max(1, int(size[b[at : at + 20_000]].max()))))
            pa_, pb = a[at : at + step], b[at : at + step]
            close = within([bodies[x] for x in pa_], [bodies[x] for x in pb], tau)
            pa_, pb = pa_[close], pb[close]
            first_is_later = (rids[pa_] > rids[pb]) | ((rids[pa_] == rids[pb]) & (numbers[pa_] > numbers[pb]))
            later.append(np.where(first_is_later, pa_, pb))
            at += step
        gone = unique[np.unique(np.concatenate(later))] if later else np.zeros(0, np.int64)
        return pd.DataFrame({"id": gone})

    return apply


MET = "meet long, key long, indexed boolean"


def met_lines(docs: DataFrame, tau: int = TAU) -> DataFrame:
    """(meet, key, indexed): lines under each key at which an indexed line meets another.

    The keys are the largest thing that is moved, so they move in PASSES parts, one after the other.
    """

    def dealt(part: int):
        def columns(lines: Lines) -> list:
            meet, tagged = keys(lines, lines.firsts(lines.eligible), tau)
            mine = (meet & (PASSES - 1)) == part
            return [meet[mine], tagged[mine]]

        return columns

    target = schema_of(docs.sparkSession, MET)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = ((b.column("meet").to_numpy(), b.column("tagged").to_numpy()) for b in batches)
        for found in met_rows(arrays):
            if len(found[0]):
                yield record_batch([pa.array(x) for x in found], target)

    found = []
    for part in range(PASSES):
        rows = _per_piece(docs, "meet long, tagged long", dealt(part)).repartition("meet").sortWithinPartitions("meet", "tagged")
        found.append(written(rows.mapInArrow(apply, MET), "met-lines"))
    return reduce(DataFrame.unionByName, found)


def near_ids(met: DataFrame, texts: DataFrame, tau: int = TAU) -> DataFrame:
    """Ids of the distinct lines that have a different line within tau edits earlier."""
    count = max(1, met.count() // 5000)
    cells = in_cells(with_crowds(met, "meet", BLOCK), "meet", BLOCK).join(texts, "key")
    cells = cells.select(bucket_of("meet", "low", "high", count=count), "meet", "low", "high", "own", "key", "indexed", "rid", "number", "body")
    return cells.groupBy("bucket").applyInPandas(_verify(tau), "id long").distinct()


def _lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def removed(docs: DataFrame, tau: int = TAU) -> DataFrame:
    """(rid, kept, n_near): lines of each document that stand nowhere earlier, if any, and how many it loses as near ones."""
    met = met_lines(docs, tau)
    earliest = F.min(F.struct("rid", "number"))
    found = _per_piece(docs, "h long, h2 long, rid long, number int, body binary", _firsts(_line_sieve(met)), 1)
    firsts = found.groupBy("h", "h2").agg(earliest.alias("first"), F.first("body", ignorenulls=True).alias("body"))
    firsts = written(firsts.select(F.shiftrightunsigned("h", 1).alias("key"), "first.*", "body"), "lines")
    near = near_ids(met, firsts.where("body IS NOT NULL"), tau)
    firsts = firsts.drop("body").join(near.select(F.col("id").alias("key"), F.lit(True).alias("near")), "key", "left")
    return firsts.groupBy("rid").agg(
        F.collect_list(F.when(F.col("near").isNull(), F.col("number"))).alias("kept"), F.count("near").alias("n_near")
    )


def deduplicated(docs: DataFrame, tau: int = TAU) -> DataFrame:
    """(doc_id, n_lines, n_removed, n_near, removed, short_repeats): removed line numbers, counted from 0, and those of short lines that stand earlier."""
    split = _lines_of(F.col("text"))

    def numbers(holds) -> Column:
        return F.filter(F.transform(split, lambda x, k: F.when(holds(x), k)), lambda k: k.isNotNull())

    long = numbers(lambda x: F.length(x) >= LEAST)
    short = numbers(lambda x: (F.length(x) < LEAST) & x.rlike(r"\S"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), rid().alias("rid"), F.size(split).alias("n_lines"), long.alias("long"), short.alias("short")
    )
    joined = rows.join(removed(docs, tau), "rid", "left")
    none = F.array().cast("array<int>")
    gone, again = (F.coalesce(F.array_except(column, F.coalesce("kept", none)), none) for column in ("long", "short"))
    return joined.select(
        "doc_id",
        F.greatest("n_lines", F.lit(0)).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.array_sort(gone).alias("removed"),
        F.array_sort(again).alias("short_repeats"),
        "rid",
    )


def rewritten(docs: DataFrame, tau: int = TAU) -> DataFrame:
    """Documents without their repeated lines; one left with blank text only goes. All columns kept.

    Different texts under one id are different documents. One of which no more
    than FRAGMENT would be left is a copy and not a text with repeated lines: it
    stays whole, so that the search for near copies sees it as it is.
    """
    told = told_apart(docs)

    def losses() -> DataFrame:
        return deduplicated(told, tau).where("n_removed > 0").select("rid", "removed").dropDuplicates(["rid"])

    marks = written_alone(docs.sparkSession, losses, "removed-lines")
    held = sieve(marks, "rid")
    packed = told.select("doc", rid().alias("rid"))
    clean = sifted(packed, "rid", held, inside=False).select("doc")
    touched = sifted(packed, "rid", held).join(marks, "rid", "left")
    split = _lines_of(F.col("doc.text"))
    left = F.filter(split, lambda x, k: ~F.coalesce(F.array_contains("removed", k), F.lit(False)))
    touched = touched.withColumn("left", left)
    stays = F.col("removed").isNull() | F.exists("left", lambda x: x.rlike(r"\S"))
    shorter = F.array_join("left", "\n")
    whole = F.col("removed").isNull() | (F.length(shorter) <= FRAGMENT * F.length("doc.text"))
    text = F.when(whole, F.col("doc.text")).otherwise(shorter)
    columns = [text.alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns]
    touched = touched.where(stays).select(F.struct(*columns).alias("doc"))
    return clean.unionByName(touched).select("doc.*")
