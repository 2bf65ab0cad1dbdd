"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is its character 1- to 3-grams (white space as one blank, letters
lowered), hashed into BUCKETS. Their embeddings are averaged and fed to a
softmax; both layers are trained by stochastic gradient descent in numpy on a
bounded sample of labelled rows: at most PER_LANGUAGE documents of each of at
most LANGUAGES languages, chosen by a hash of the id. A quarter of the sample
is kept aside; on it the softmax is calibrated (temperature scaling) and the
score is found below which a prediction is rejected. A text is also rejected if
its letters are strange: the mean log frequency of their grams in the sample is
well under that of every row kept aside, which neither gibberish nor a language
or script that was not learned reaches.

Prediction reads whole texts and nothing else, needs no shuffle, and its model
has a fixed size.

Defined cases: a null text or one without a letter gets `und` with score 0 and
is rejected; without labelled rows everything is `und`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces, record_batch, schema_of
from .hashing import code_points

BUCKETS = 1 << 13
DIMENSIONS = 16
PER_LANGUAGE = 400
LANGUAGES = 200
#: how many times the wanted rows of a language are drawn by hash before the least hashes are taken
DRAWN = 2
PLACES = 1 << 40
EPOCHS = 30
STEP = 0.5
BATCH = 32
#: share of right predictions on the rows kept aside that the rejection may cost
COST = 0.001
#: no calibrated score above this multiple of blind chance is ever rejected
SURE = 1.5
#: standard errors of the mean over a text's grams that a short text may lie lower
LENIENT = 3
#: how far under the worst row kept aside a text is strange, as a share of that row's way from the median
MARGIN = 1.5
NO_LETTERS = re.compile(r"[\W\d_]+")
UNKNOWN = "und"
_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)


@dataclass
class Model:
    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0
    #: log frequency of each bucket for letters alone, its deviation, and the mean that a long text must reach
    usual: np.ndarray | None = None
    deviation: float = 0.0
    strange: float = -np.inf


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Counts of hashed 1- to 3-grams over BUCKETS."""
    points = code_points(f" {' '.join(text.lower().split())} ")
    counts = np.zeros(BUCKETS, np.float32)
    one = points * _A
    two = (one[:-1] ^ (one[:-1] >> np.uint32(13))) + points[1:] * _B
    grams = [one, two]
    if len(points) > 2:
        grams.append((two[:-1] ^ (two[:-1] >> np.uint32(11))) + points[2:] * _C)
    for gram in grams:
        gram = (gram ^ (gram >> np.uint32(15))) * _A
        counts += np.bincount(gram >> np.uint32(32 - 13), minlength=BUCKETS)
    return counts


def lettered(text: str) -> np.ndarray:
    """The features of a text's letters alone, so that numbers and marks are never strange."""
    return features(NO_LETTERS.sub(" ", text))


def is_strange(model: Model, text: str) -> bool:
    if model.usual is None:
        return False
    counts = lettered(text)
    at = np.flatnonzero(counts)
    return usualness(model, at, counts[at]) < model.strange


def usualness(model: Model, bucket: np.ndarray, times: np.ndarray) -> float:
    """Mean log frequency of a text's grams, with what chance may take from a short one given back."""
    total = times.sum()
    return float((model.usual[bucket] * times).sum() / total + LENIENT * model.deviation / np.sqrt(total))


def probabilities(model: Model, counts: np.ndarray) -> np.ndarray:
    """Calibrated probabilities of (rows, BUCKETS) counts."""
    hidden = (counts / counts.sum(axis=1, keepdims=True)) @ model.embeddings
    scores = (hidden @ model.weights + model.bias) / model.temperature
    scores -= scores.max(axis=1, keepdims=True)
    e = np.exp(scores)
    return e / e.sum(axis=1, keepdims=True)


def sample(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Languages, feature counts, labels and (bucket, times) of the letters of the bounded training sample."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return [], np.zeros((0, BUCKETS), np.float32), np.zeros(0, np.int64), []
    # a language's rows below a hash that leaves DRAWN times the wanted number, so that no task sorts a whole language
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, DRAWN * PER_LANGUAGE / r["count"]))])
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(PLACES))
    pick = Window.partitionBy("lang").orderBy("place", "doc_id")
    # ids first, so that only the chosen rows' texts are read into features
    chosen = (
        labelled.where(F.col("lang").isin(languages) & F.col("doc_id").isNotNull())
        .select("doc_id", "lang", place.alias("place"))
        .where(F.col("place") < F.lit(PLACES) * share[F.col("lang")])
        .withColumn("n", F.row_number().over(pick))
        .where(F.col("n") <= PER_LANGUAGE)
        .select("doc_id")
        .distinct()
    )
    rows = labelled.join(F.broadcast(chosen), "doc_id").select("doc_id", "lang", "text")
    schema = "doc_id long, lang string, bucket array<short>, times array<int>, letter_bucket array<short>, letter_times array<int>"
    target = schema_of(docs.sparkSession, schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                ids, langs, buckets, times, letter_buckets, letter_times = [], [], [], [], [], []
                for doc_id, lang, text in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    if has_letter(text):
                        counts = features(text)
                        at = np.flatnonzero(counts)
                        ids.append(doc_id)
                        langs.append(lang)
                        buckets.append(at.astype(np.int16))
                        times.append(counts[at].astype(np.int32))
                        counts = lettered(text)
                        at = np.flatnonzero(counts)
                        letter_buckets.append(at.astype(np.int16))
                        letter_times.append(counts[at].astype(np.int32))
                yield record_batch([ids, langs, buckets, times, letter_buckets, letter_times], target)

    # Arrow keeps the counts as they are; rows would make a Python object of each
    got = rows.mapInArrow(apply, schema).toArrow()
    ids, langs = got["doc_id"].to_pylist(), got["lang"].to_pylist()
    order = sorted(range(len(ids)), key=lambda k: (ids[k], langs[k]))[: PER_LANGUAGE * len(languages) * 2]
    counts = np.zeros((len(order), BUCKETS), np.float32)
    letters = []
    for k, r in enumerate(order):
        bucket, times, letter_bucket, letter_times = (got[c][r].values.to_numpy() for c in ("bucket", "times", "letter_bucket", "letter_times"))
        counts[k, bucket] = times
        letters.append((letter_bucket.astype(np.int64), letter_times.astype(np.float64)))
    index = {lang: k for k, lang in enumerate(languages)}
    return languages, counts, np.array([index[langs[r]] for r in order], np.int64), letters


def train(
    languages: list[str], counts: np.ndarray, labels: np.ndarray, letters: list[tuple[np.ndarray, np.ndarray]], seed: int = 7
) -> Model:
    """Gradient descent on both layers, then temperature and rejection on the rows kept aside."""
    random = np.random.default_rng(seed)
    k = max(1, len(languages))
    model = Model(
        languages,
        random.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32),
        np.zeros((DIMENSIONS, k), np.float32),
        np.zeros(k, np.float32),
    )
    if not len(labels):
        return model
    shares = counts / counts.sum(axis=1, keepdims=True)
    aside = np.arange(len(labels)) % 4 == 3
    if aside.sum() < k or not (~aside).sum():
        aside = np.zeros(len(labels), bool)
    rows = np.flatnonzero(~aside)
    for epoch in range(EPOCHS):
        rate = STEP * (1 - epoch / EPOCHS)
        random.shuffle(rows)
        for at in range(0, len(rows), BATCH):
            part = rows[at : at + BATCH]
            x = shares[part]
            hidden = x @ model.embeddings
            scores = hidden @ model.weights + model.bias
            scores -= scores.max(axis=1, keepdims=True)
            e = np.exp(scores)
            wrong = e / e.sum(axis=1, keepdims=True)
            wrong[np.arange(len(part)), labels[part]] -= 1
            wrong /= len(part)
            back = wrong @ model.weights.T
            model.weights -= rate * 20 * hidden.T @ wrong
            model.bias -= rate * wrong.sum(axis=0)
            model.embeddings -= rate * 200 * x.T @ back
    check = np.flatnonzero(aside) if aside.any() else rows
    scores = (shares[check] @ model.embeddings) @ model.weights + model.bias
    model.temperature = _temperature(scores, labels[check])
    p = probabilities(model, counts[check])
    right = p.argmax(axis=1) == labels[check]
    sure = np.sort(p.max(axis=1)[right])
    model.least = float(min(SURE / k, sure[int(COST * len(sure))])) if len(sure) else 0.0
    if aside.any():
        _usual(model, [letters[k] for k in rows], [letters[k] for k in check])
    return model


def _usual(model: Model, learned: list[tuple[np.ndarray, np.ndarray]], aside: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Gram frequencies of the learned rows, and a bound that lies MARGIN times the way from the median to the worst row kept aside under that row."""
    seen = np.full(BUCKETS, 0.5)
    for bucket, times in learned:
        seen[bucket] += times
    seen /= seen.sum()
    model.usual = np.log2(seen)
    model.deviation = float(np.sqrt((seen * (model.usual - (seen * model.usual).sum()) ** 2).sum()))
    means = np.array([usualness(model, *row) for row in aside])
    worst = float(means.min())
    model.strange = worst - MARGIN * (float(np.median(means)) - worst)


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, from a grid."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 61))
    losses = []
    for t in grid:
        z = scores / t
        z = z - z.max(axis=1, keepdims=True)
        losses.append(float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(labels)), labels]).mean()))
    return float(grid[int(np.argmin(losses))])


def held_out() -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 modulo 4."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fitted(docs: DataFrame) -> Model:
    return train(*sample(docs))


def predict(docs: DataFrame, model: Model, keep: str = "*") -> DataFrame:
    """Columns lang_pred, score and rejected beside the kept columns, packed as `doc`."""
    inside = keep == "*"
    packed = docs.select(F.struct(keep).alias("doc"), *([] if inside else ["text"]))
    schema = packed.select("doc").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                count = piece.num_rows
                names, sure = [UNKNOWN] * count, np.zeros(count)
                at, rows = [], []
                strange = np.zeros(count, bool)
                texts = piece.column("doc").field("text") if inside else piece.column("text")
                for k, text in enumerate(texts.to_pylist()):
                    if model.languages and text and has_letter(text):
                        at.append(k)
                        rows.append(features(text))
                        strange[k] = is_strange(model, text)
                    if len(rows) >= 256 or (rows and k == count - 1):
                        p = probabilities(model, np.stack(rows))
                        for j, best in zip(at, p.argmax(axis=1), strict=True):
                            names[j] = model.languages[best]
                        sure[at] = p.max(axis=1)
                        at, rows = [], []
                rejected = (np.array(names) == UNKNOWN) | (sure < model.least) | strange
                yield record_batch([piece.column("doc"), names, sure, rejected], target)

    return packed.mapInArrow(apply, schema)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every document."""
    model = fitted(docs)
    return predict(docs, model, "doc_id").select(
        F.col("doc.doc_id").alias("doc_id"), held_out_of("doc.doc_id"), "lang_pred", "score", "rejected"
    )


def held_out_of(column: str) -> Column:
    return (F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 4 == 2).alias("held_out")
