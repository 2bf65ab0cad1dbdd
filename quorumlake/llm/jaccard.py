"""Similarity join on word shingles by chosen paths.

Each run walks a tree. At a node a random order of all shingles is drawn, and
the sets there are split by the shingle that comes first in it, so two sets
stay together with the probability of their Jaccard similarity. Small nodes,
and nodes that a split hardly divides (families of near copies), are compared
by brute force on one-byte sketches; others are split again. Runs are repeated
until the chance to miss a pair at the threshold in all of them is below
1 - RECALL.

The comparisons only gather candidates into components. Within a component all
pairs are then compared exactly, on the full sets, in blocks of bounded size,
and only link counts and spanning edges leave a block. Equal sets are one class
from the start, so copies cost nothing.

Defined cases: documents without a word form no links; equal sets are linked to
each other; a null doc_id is replaced by a hash of the text; rows that repeat
a doc_id are further copies; an empty table gives an empty result.
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
from .common import components, pieces, record_batch, rid, schema_of, sieve, sifted, told_apart
from .shingles import set_key, shingle_set, signature

THRESHOLD = 0.8
RECALL = 0.999
RUNS = 16
LEVELS = 6
SKETCH = RUNS * LEVELS
#: sketch agreement that a pair at the threshold misses with a chance below 1e-4
AGREE = 62
SMALL = 1000
DENSE = 0.5
BLOCK = 512
COLUMNS = 1 << 14


def _sets(docs: DataFrame, first: int) -> DataFrame:
    """(doc_id, rid, key, sig, sketch) of every document; key is null without words."""
    schema = "doc_id long, rid long, key binary, sig array<int>, sketch binary"
    target = schema_of(docs.sparkSession, schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                keys, sigs, sketches = [], [], []
                for text in piece.column("text").to_pylist():
                    shingles = shingle_set(text)
                    if not len(shingles):
                        keys.append(None)
                        sigs.append(None)
                        sketches.append(None)
                        continue
                    sig = signature(shingles, first, SKETCH)
                    keys.append(set_key(shingles))
                    sigs.append(sig.view(np.int32))
                    sketches.append(sig.astype(np.uint8).tobytes())
                yield record_batch([piece.column("doc_id"), piece.column("rid"), keys, sigs, sketches], target)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), rid().alias("rid"), "text").mapInArrow(apply, schema)


def _classes(sets: DataFrame) -> DataFrame:
    return sets.where("key IS NOT NULL").groupBy("key").agg(
        F.min("rid").alias("rid"), F.count("*").alias("copies"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch")
    )


def _split(rows: DataFrame) -> DataFrame:
    """The rows whose node holds at least two, with its size n.

    The sizes are written, so that the join sees two plain sides and may split a node that holds many rows.
    """
    sizes = written(rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "node-sizes")
    return rows.join(sizes, "node")


def _leaves(classes: DataFrame) -> tuple[DataFrame, int]:
    """(node, key, n) of all nodes to be compared, and the depth of the deepest."""
    token = F.element_at("sig", F.col("run") * LEVELS + 1)
    rows = classes.select("key", F.explode(F.sequence(F.lit(0), F.lit(RUNS - 1))).alias("run"), "sig")
    rows = rows.select("key", "run", F.xxhash64("run", token).alias("node"), F.lit(0).cast("long").alias("was"))
    found = []
    for level in range(1, LEVELS + 1):
        nodes = written(_split(rows), "path-nodes")
        small = (F.col("n") <= SMALL) | (F.col("n") >= DENSE * F.col("was")) & (F.col("was") > 0)
        if level == LEVELS:
            small = F.lit(True)
        found.append(nodes.where(small).select("node", "key", "n"))
        large = nodes.where(~small)
        if large.isEmpty():
            break
        token = F.element_at("sig", F.col("run") * LEVELS + level + 1)
        rows = large.join(classes.select("key", "sig"), "key").select(
            "key", "run", F.xxhash64("node", token).alias("node"), F.col("n").alias("was")
        )
    return reduce(DataFrame.unionByName, found), level


def with_crowds(rows: DataFrame, group: str, block: int) -> DataFrame:
    """The rows with the size n of their group, or 1 where one block holds the group.

    Only the crowded groups are joined, from a written table: small ones need no exchange, and a hot one can be split.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("n")).where(F.col("n") > block)
    return rows.join(written(sizes, "crowds"), group, "left").withColumn("n", F.coalesce("n", F.lit(1).cast("long")))


def in_cells(rows: DataFrame, group: str, block: int) -> DataFrame:
    """Rows of groups (group, n, key) dealt to pairs (low, high) of their blocks."""
    count = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("key"), count).cast("int")
    other = F.explode(F.sequence(F.lit(0), count - 1))
    dealt = rows.withColumn("own", own).withColumn("other", other)
    return dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other", "n")


def bucket_of(*columns: str, count: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(count)).cast("int").alias("bucket")


def _joined(near: np.ndarray, keys: list[bytes]) -> Iterator[tuple[int, int]]:
    """An edge from each row to the least key of its component under `near`; blocks that agree give equal edges."""
    order = sorted(range(len(keys)), key=keys.__getitem__)
    near = (near | near.T)[np.ix_(order, order)]
    root = np.arange(len(keys))
    for i in range(len(keys)):
        if root[i] == i:
            reached = np.zeros(len(keys), bool)
            fresh = np.array([i])
            while len(fresh):
                reached[fresh] = True
                fresh = np.flatnonzero(near[fresh].any(axis=0) & ~reached)
            root[reached] = i
    for i in np.flatnonzero(root != np.arange(len(keys))):
        yield order[i], order[root[i]]


def _compare_sketches(frame: pd.DataFrame) -> pd.DataFrame:
    a, b = [], []
    for _, cell in frame.groupby(["node", "low", "high"], sort=False):
        cell = cell.drop_duplicates("key")
        if len(cell) < 2:
            continue
        keys = cell["key"].tolist()
        sketches = np.frombuffer(b"".join(cell["sketch"]), np.uint8).reshape(len(cell), SKETCH)
        if len(cell) == 2:
            if (sketches[0] == sketches[1]).sum() >= AGREE:
                a.append(keys[0])
                b.append(keys[1])
            continue
        near = np.zeros((len(cell), len(cell)), bool)
        for i in range(len(cell) - 1):
            near[i, i + 1 :] = (sketches[i] == sketches[i + 1 :]).sum(axis=1) >= AGREE
        for i, j in _joined(near, keys):
            a.append(keys[i])
            b.append(keys[j])
    return pd.DataFrame({"a": pd.Series(a, dtype=object), "b": pd.Series(b, dtype=object)})


def candidates(docs: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) that keep every likely pair in one component."""
    edges, missed, first = [], 1.0, 0
    while missed > 1 - RECALL:
        if first:
            classes = written(_classes(_sets(docs, first)), "classes")
        leaves, depth = _leaves(classes)
        cells = in_cells(leaves, "node", SMALL).join(classes.select("key", "sketch"), "key")
        count = max(1, int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")) * 4)
        cells = cells.select(bucket_of("node", "low", "high", count=count), "node", "low", "high", "key", "sketch")
        edges.append(written(cells.groupBy("bucket").applyInPandas(_compare_sketches, "a binary, b binary").distinct(), "candidates"))
        missed *= (1 - THRESHOLD**depth) ** RUNS
        first += SKETCH
    return reduce(DataFrame.unionByName, edges)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by blocks of a 0/1 matrix over the shingles."""
    both = np.concatenate(left + right)
    values, place = np.unique(both, return_inverse=True)
    rows = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    times = np.bincount(place, minlength=len(values))
    # shingles of one set alone meet nothing
    shared = times[place] > 1
    renumber = np.cumsum(times > 1) - 1
    place, rows = renumber[place[shared]], rows[shared]
    total = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(place, kind="stable")
    place, rows = place[order], rows[order]
    width = int(place[-1]) + 1 if len(place) else 0
    cuts = np.searchsorted(place, np.arange(0, width + COLUMNS, COLUMNS))
    for k in range(len(cuts) - 1):
        part = slice(cuts[k], cuts[k + 1])
        matrix = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        matrix[rows[part], place[part] - k * COLUMNS] = 1
        total += matrix[: len(left)] @ matrix[len(left) :].T
    return total


def _compare_sets(threshold: float):
    def apply(frame: pd.DataFrame) -> pd.DataFrame:
        keys, others, links = [], [], []
        for (_, low, high), cell in frame.groupby(["root", "low", "high"], sort=False):
            cell = cell.drop_duplicates("key")
            left = cell[cell["own"] == low]
            right = cell[cell["own"] == high]
            a = [np.asarray(x, np.int64) for x in left["shingles"]]
            b = a if low == high else [np.asarray(x, np.int64) for x in right["shingles"]]
            if not a or not b:
                continue
            common = overlaps(a, b)
            sizes = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :]
            near = common >= threshold * (sizes - common) - 1e-6
            names = left["key"].tolist() if low == high else left["key"].tolist() + right["key"].tolist()
            if low == high:
                np.fill_diagonal(near, False)
                keys += names
                links += (near @ left["copies"].to_numpy()).tolist()
                square = near
            else:
                keys += names
                links += (near @ right["copies"].to_numpy()).tolist() + (near.T @ left["copies"].to_numpy()).tolist()
                square = np.zeros((len(names), len(names)), bool)
                square[: len(left), len(left) :] = near
            others += [None] * len(names)
            for i, j in _joined(square, names):
                keys.append(names[i])
                others.append(names[j])
                links.append(0)
        return pd.DataFrame({"key": pd.Series(keys, dtype=object), "other": pd.Series(others, dtype=object), "links": pd.Series(links, dtype="int64")})

    return apply


def _shingled(rows: DataFrame) -> DataFrame:
    """(root, n, key, copies, shingles) of the documents that stand for their class."""
    schema = "root binary, n long, key binary, copies long, shingles array<long>"
    target = schema_of(rows.sparkSession, schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                columns: list[list] = [[] for _ in range(5)]
                names = ("root", "n", "key", "copies", "text")
                for root, n, key, copies, text in zip(*(piece.column(c).to_pylist() for c in names), strict=True):
                    shingles = shingle_set(text)
                    # another text under a repeated id is not the one meant
                    if len(shingles) and set_key(shingles) == key:
                        for column, x in zip(columns, (root, n, key, copies, shingles.view(np.int64)), strict=True):
                            column.append(x)
                yield record_batch(columns, target)

    return rows.mapInArrow(apply, schema)


def classes_of(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, rid, class_id, n_links) of every document.

    class_id is the least id of all documents it is linked to, directly or
    over others; n_links counts the documents at or above the threshold.
    """
    sets = written(_sets(docs, 0), "sets")
    classes = written(_classes(sets), "classes")
    found = components(candidates(docs, sets, classes))
    sized = with_crowds(found.withColumnRenamed("node", "key"), "root", BLOCK)
    wanted = written(
        sized.join(classes.select("key", "rid", "copies"), "key"), "candidate-sets"
    )
    texts = sifted(docs.select(rid().alias("rid"), "text"), "rid", sieve(wanted, "rid")).join(wanted, "rid")
    cells = in_cells(_shingled(texts.select("root", "n", "key", "copies", "text")), "root", BLOCK)
    count = max(1, wanted.count() // 200)
    cells = cells.select(bucket_of("root", "low", "high", count=count), "root", "low", "high", "own", "key", "copies", "shingles")
    compared = written(cells.groupBy("bucket").applyInPandas(_compare_sets(threshold), "key binary, other binary, links long"), "compared")
    links = compared.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(compared.where("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b")))
    named = classes.select("key", "rid", "copies").join(roots.withColumnRenamed("node", "key"), "key", "left")
    least = named.where("root IS NOT NULL").groupBy("root").agg(F.min("rid").alias("least"))
    named = named.join(least, "root", "left").join(links, "key", "left")
    named = named.select(
        "key",
        F.coalesce("least", "rid").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    rows = sets.select("doc_id", "rid", "key").join(named, "key", "left")
    return rows.select("doc_id", "rid", F.coalesce("class_id", "rid").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def thinned(docs: DataFrame) -> DataFrame:
    """The documents that stand for their class, all columns kept.

    Different texts under one id are different documents; rows equal in id and
    text are copies, of which one stays.
    """
    told = told_apart(docs)
    named = written_alone(docs.sparkSession, lambda: classes_of(told), "near-classes")
    gone = named.where("rid <> class_id").select("rid").distinct()
    packed = told.select("doc", rid().alias("rid"))
    held = sieve(gone, "rid")
    kept = sifted(packed, "rid", held, inside=False).unionByName(sifted(packed, "rid", held).join(gone, "rid", "left_anti"))
    if not named.where("rid = class_id").groupBy("rid").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["rid"])
    return kept.select("doc.*")
