"""Approximate nearest neighbours by multi-index hashing.

Vectors get binary codes from rotations learned by iterative quantisation on a
bounded sample; a code is cut into substrings and every block of the index has
a table per substring. A query of radius r probes each table within the
pigeonhole share of r, so that every code within r is met; the met codes are
held to r exactly and their vectors ranked by inner product in double
precision. The radius comes from the sample: within it lie the codes of RECALL
of the sample's true neighbours. A query that meets fewer than k codes widens
its radius until it has k.

Queries and index rows meet block by block; a block pair returns at most k rows
a query, which are merged.

Defined cases: rows whose vector is null, zero, or holds a null or non-finite
component, whose id is null, or whose length is not the commonest one take no
part; rows that repeat an id count once, with the least vector; ties go to the
smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

NEAREST = 20
EVERY = 20
SAMPLE = 4096
SAMPLE_QUERIES = 256
ROTATIONS = 4
ROUNDS = 25
SUBSTRING = 16
RECALL = 0.97
INDEX_BLOCK = 8192
QUERY_BLOCK = 1024
WIDEN = 8
_BITS = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


@dataclass
class Coder:
    mean: np.ndarray
    rotations: list[np.ndarray]
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, substrings) of 16-bit substrings."""
        bits = np.concatenate([(vectors - self.mean) @ r > 0 for r in self.rotations], axis=1)
        spare = -bits.shape[1] % SUBSTRING
        bits = np.pad(bits, ((0, 0), (0, spare)))
        return np.packbits(bits, axis=1).view(np.uint16)


def learn(vectors: np.ndarray, total: int, k: int = NEAREST, seed: int = 11) -> Coder:
    """Rotations by iterative quantisation, and the radius that holds RECALL of true neighbours."""
    random = np.random.default_rng(seed)
    mean = vectors.mean(axis=0)
    centred = vectors - mean
    size = vectors.shape[1]
    rotations = []
    for _ in range(ROTATIONS):
        rotation = np.linalg.qr(random.normal(size=(size, size)))[0]
        for _ in range(ROUNDS):
            signs = np.where(centred @ rotation > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(centred.T @ signs)
            rotation = u @ v
        rotations.append(rotation)
    coder = Coder(mean, rotations, 0)
    # neighbours in the sample at the depth that k has in the whole table
    depth = max(1, min(len(vectors) - 1, round(k * len(vectors) / max(1, total))))
    asked = vectors[:SAMPLE_QUERIES]
    scores = asked @ vectors.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    near = np.argpartition(-scores, depth - 1, axis=1)[:, :depth] if len(vectors) > 1 else np.zeros((len(asked), 1), int)
    codes = coder.codes(vectors)
    distances = _BITS[codes[: len(asked), None, :] ^ codes[near]].sum(axis=2)
    coder.radius = int(np.quantile(distances, RECALL))
    return coder


class Block:
    """Substring tables of one block of codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.tables = [np.unique(codes[:, j], return_inverse=True) for j in range(codes.shape[1])]

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """(queries, rows): codes within the radius; every code is compared, the tables spare nothing."""
        met = np.zeros((len(query), len(self.codes)), bool)
        share, rest = divmod(radius, len(self.tables))
        for j, (values, place) in enumerate(self.tables):
            # pigeonhole: rest + 1 substrings may differ by the share, the others by one less
            most = share if j <= rest else share - 1
            if most >= 0:
                met |= (_BITS[query[:, j, None] ^ values[None, :]] <= most)[:, place]
        return met & (self.distances(query) <= radius)

    def distances(self, query: np.ndarray) -> np.ndarray:
        total = np.zeros((len(query), len(self.codes)), np.uint16)
        for j in range(self.codes.shape[1]):
            total += _BITS[query[:, j, None] ^ self.codes[None, :, j]]
        return total


def _search(frame: pd.DataFrame, coder: Coder, k: int) -> pd.DataFrame:
    asked = frame[frame["asks"]].sort_values("vec_id")
    held = frame[~frame["asks"]].sort_values("vec_id")
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
    if asked.empty or held.empty:
        return empty
    ids, query_ids = held["vec_id"].to_numpy(np.int64), asked["vec_id"].to_numpy(np.int64)
    vectors, queries = np.stack(held["vec"].to_numpy()).astype(np.float64), np.stack(asked["vec"].to_numpy()).astype(np.float64)
    block, codes = Block(coder.codes(vectors)), coder.codes(queries)
    out: list[pd.DataFrame] = []
    for at in range(0, len(query_ids), 128):
        own = query_ids[at : at + 128, None] == ids[None, :]
        near = block.within(codes[at : at + 128], coder.radius) & ~own
        radius = coder.radius
        wanted = np.minimum(k, (~own).sum(axis=1))
        while (short := np.flatnonzero(near.sum(axis=1) < wanted)).size:
            radius += WIDEN
            near[short] = block.within(codes[at + short], radius) & ~own[short]
        for q in range(len(near)):
            rows = np.flatnonzero(near[q])
            scores = (vectors[rows] * queries[at + q]).sum(axis=1)
            best = np.lexsort((ids[rows], -scores))[:k]
            out.append(pd.DataFrame({"query_id": query_ids[at + q], "vec_id": ids[rows[best]], "score": scores[best]}))
    return pd.concat(out) if out else empty


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, vec) of the rows that take part."""
    vec = F.transform("embedding", lambda x: x.cast("double"))
    plain = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where(
        F.col("vec_id").isNotNull()
        & F.col("vec").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vec", lambda x: x != 0)
    )
    plain = plain.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    sizes = plain.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return plain.where(F.size("vec") == (sizes[0]["size"] if sizes else 0))


def nearest(rows: DataFrame, every: int = EVERY, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id is divisible by `every`."""
    spark = rows.sparkSession
    held = written(usable(rows), "vectors")
    total = held.count()
    asks = held.where(F.pmod("vec_id", F.lit(every)) == 0)
    empty = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], empty)
    drawn = held.orderBy(F.xxhash64(F.lit("sample"), "vec_id"), "vec_id").limit(SAMPLE).toPandas()
    coder = learn(np.stack(drawn["vec"].to_numpy()), total, k)
    blocks = -(-total // INDEX_BLOCK)
    asked = -(-max(1, asks.count()) // QUERY_BLOCK)
    block, query = (F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int") for n in (blocks, asked))
    index_rows = held.select("vec_id", "vec", F.lit(False).alias("asks"), block.alias("b"), F.explode(F.sequence(F.lit(0), F.lit(asked - 1))).alias("q"))
    query_rows = asks.select("vec_id", "vec", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), query.alias("q"))

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        return _search(frame, coder, k)

    found = index_rows.unionByName(query_rows).groupBy("b", "q").applyInPandas(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(ids: np.ndarray, vectors: np.ndarray, every: int = EVERY, k: int = NEAREST) -> Iterator[tuple]:
    """The exact answer, for tests of recall."""
    for q in np.flatnonzero(ids % every == 0):
        scores = (vectors * vectors[q]).sum(axis=1)
        rows = np.flatnonzero(ids != ids[q])
        for rank, j in enumerate(rows[np.lexsort((ids[rows], -scores[rows]))][:k], 1):
            yield int(ids[q]), rank, int(ids[j]), float(scores[j])
