"""Best-fit packing into sequences of several permitted lengths.

A document's length is its number of words. Documents longer than the largest
capacity are cut into pieces; no word is lost. Pieces are dealt by hash into
shards of bounded size, each packed alone, longest piece first: a piece goes
to the open bin it leaves fullest; if none has room, a bin is opened of the
size that costs least per word, judged by the piece and the longest remaining
pieces that would fill it. At the end every bin shrinks to the least permitted
length that holds it. A shard wastes at most its last open bins, so the loss
against one global packing falls with the shard size, not with the input.

Defined cases: a null or blank text has length 0, one row and no bin; ties go
to the smaller piece key; repeated rows are packed as often as they stand; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import words_of

CAPACITIES = (512, 1024, 2048, 4096)
#: cost of a bin besides its capacity, in words
OVERHEAD = 32
SHARD_PIECES = 20_000
LOOK_AHEAD = 8


def best_fit(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """Bin of every piece, its offset there, and the final capacity of every bin. Pieces come longest first."""
    left: dict[int, int] = {}
    for n in lengths:
        left[n] = left.get(n, 0) + 1
    waiting = 0  # bit n is set while a piece of length n is still to come
    for n in left:
        waiting |= 1 << n
    open_bins: dict[int, list[int]] = {}
    room = 0  # bit r is set while a bin with room r is open
    bins, offsets, used, size = [], [], [], []
    for n in lengths:
        left[n] -= 1
        if not left[n]:
            waiting &= ~(1 << n)
        fitting = room >> n
        if fitting:
            r = n + ((fitting & -fitting).bit_length() - 1)
            b = heapq.heappop(open_bins[r])
            if not open_bins[r]:
                room &= ~(1 << r)
        else:
            b = len(used)
            size.append(_opened(n, capacities, overhead, waiting, left))
            used.append(0)
            r = size[b]
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        if r > n:
            heapq.heappush(open_bins.setdefault(r - n, []), b)
            room |= 1 << (r - n)
    return bins, offsets, [min(c for c in capacities if c >= u) for u in used]


def _opened(n: int, capacities: Sequence[int], overhead: int, waiting: int, left: dict[int, int]) -> int:
    """The capacity of least cost per word if the longest fitting pieces still to come fill the bin."""
    best, least = max(capacities), math.inf
    for c in sorted(capacities, reverse=True):
        if c < n:
            break
        filled, taken = n, {}
        for _ in range(LOOK_AHEAD):
            fitting = waiting & ((1 << (c - filled + 1)) - 1)
            if not fitting:
                break
            m = fitting.bit_length() - 1
            times = min(left[m] - taken.get(m, 0), (c - filled) // m)
            if times <= 0:
                # spent in this trial: the next shorter length
                shorter = fitting & ((1 << m) - 1)
                if not shorter:
                    break
                m = shorter.bit_length() - 1
                times = min(left[m] - taken.get(m, 0), (c - filled) // m)
                if times <= 0:
                    break
            taken[m] = taken.get(m, 0) + times
            filled += m * times
        rate = (c + overhead) / filled
        if rate < least:
            best, least = c, rate
    return best


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["length", "doc_id", "copy", "piece"], ascending=[False, True, True, True], na_position="last")
    bins, offsets, sizes = best_fit(frame["length"].tolist())
    bins = np.array(bins, np.int64)
    return pd.DataFrame(
        {
            "doc_id": frame["doc_id"].astype("Int64"),
            "words": frame["words"],
            "piece": frame["piece"],
            "length": frame["length"],
            "bin": (frame["shard"].to_numpy(np.int64) << 24) + bins,
            "bin_offset": np.array(offsets, np.int64),
            "capacity": np.array(sizes, np.int64)[bins],
        }
    )


PACKED = "doc_id long, words long, piece int, length long, bin long, bin_offset long, capacity long"


def pack(docs: DataFrame) -> DataFrame:
    """One row per piece: document, words of the document, piece, its length, bin, offset in it, capacity of the bin."""
    top = max(CAPACITIES)
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"), F.monotonically_increasing_id().alias("copy")
    )
    pieces = sized.where("words > 0").select(
        "*", F.explode(F.sequence(F.lit(0), ((F.col("words") - 1) / top).cast("int"))).alias("piece")
    )
    pieces = pieces.withColumn("length", F.least(F.lit(top).cast("long"), F.col("words") - F.col("piece") * top))
    shards = max(1, math.ceil(docs.count() / SHARD_PIECES))
    # the copy tells repeated rows apart within a shard; it takes part in the deal only where there is no id
    nameless = F.when(F.col("doc_id").isNull(), F.col("copy"))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "length", nameless), F.lit(shards)).cast("int"))
    packed = dealt.groupBy("shard").applyInPandas(_pack, PACKED)
    blank = sized.where("words = 0").select(
        "doc_id", "words", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("length"),
        *[F.lit(None).cast("long").alias(c) for c in ("bin", "bin_offset", "capacity")],
    )
    return packed.unionByName(blank)
