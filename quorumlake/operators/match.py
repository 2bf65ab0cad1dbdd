"""Matching records to meetings: by time, by name and by agenda text.

Texts are scored in chunks: a chunk of a bucket's records meets each chunk of
its candidates in one row, so a text moves once for each chunk pair and not for
each pair. Inside the row a record takes its candidates by falling bound, and a
candidate whose bound cannot win is not scored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import NAME, TOKEN_SET, Scorer, let, scored
from ..session import written
from .spread import BUCKET_ROWS, spread_join, task_count

# The least name score taken for a match, and a sole candidate's score.
MIN_NAME_SCORE = 50.0
SOLE_SCORE = 100.0

# Texts in a chunk.
BLOCK = 64


def interval_join(records: DataFrame, record_time: str, meetings: DataFrame, meeting_time: str) -> DataFrame:
    """Record and meeting where `record <= meeting < record + 1 day`.

    An equi-join on the two days the interval touches, then the exact bounds.
    """
    day = F.date_trunc("day", record_time).cast("date")
    left = records.withColumn("_day", F.explode(F.array(day, F.date_add(day, 1))))
    right = meetings.withColumn("_day", F.date_trunc("day", meeting_time).cast("date"))
    inside = (F.col(record_time) <= F.col(meeting_time)) & (
        F.col(meeting_time) < F.col(record_time) + F.make_dt_interval(days=F.lit(1))
    )
    return left.join(right, "_day").where(inside).drop("_day")


def _chunks(texts: DataFrame, bucket: str, ids: dict[str, str], text: str, scorer: Scorer, counted: str) -> DataFrame:
    """Distinct texts of each bucket, prepared, in arrays of about `BLOCK`; `counted` names the bucket's size."""
    entry = F.struct(*[F.col(c).alias(name) for name, c in ids.items()], scorer.prepare(F.col(text)).alias("prepared"))
    sizes = texts.groupBy(bucket).agg(F.count("*").alias(counted))
    dealt = texts.join(sizes, bucket).withColumn("_chunk", F.pmod(F.xxhash64(*ids.values()), F.ceil(F.col(counted) / BLOCK)))
    return dealt.groupBy(bucket, "_chunk").agg(F.collect_list(entry).alias("entries"), F.first(counted).alias(counted))


def _chunk_pairs(
    records: DataFrame, candidates: DataFrame, bucket: str, record_text: str, candidate_id: str, candidate_text: str, scorer: Scorer, bucket_rows: int
) -> DataFrame:
    """(bucket, asked, options, n_candidates): every chunk of records with every chunk of candidates of its bucket."""
    texts = written(records.select(bucket, record_text).distinct(), "texts")
    known = written(candidates.select(bucket, candidate_id, *{candidate_text} - {candidate_id}).distinct(), "candidates")
    asked = _chunks(texts, bucket, {"text": record_text}, record_text, scorer, "_n_texts").select(bucket, F.col("entries").alias("asked"), "_chunk")
    options = _chunks(known, bucket, {"id": candidate_id}, candidate_text, scorer, "n_candidates")
    options = options.select(bucket, F.col("entries").alias("options"), "n_candidates")
    pairs = spread_join(asked, options, bucket, ["_chunk"], bucket_rows=max(1, bucket_rows // BLOCK))
    return pairs.repartition(task_count(pairs))


def _best_option(asked: Column, options: Column, scorer: Scorer) -> Column:
    """(score, id, n_scored) of the option that fits best; equal scores go to the lowest id."""
    limit = (lambda o: scorer.bound(asked, o)) if scorer.bound else (lambda o: F.lit(float("inf")))
    bounded = F.transform(options, lambda o: F.struct((-limit(o["prepared"])).alias("less"), o["id"].alias("id"), o["prepared"].alias("prepared")))
    none = F.struct(F.lit(-1.0).alias("score"), F.get(options, F.lit(0))["id"].alias("id"), F.lit(0).alias("n_scored"))

    def scored_option(best: Column, o: Column) -> Column:
        score = scorer.score(asked, o["prepared"]).alias("score")
        n = (best["n_scored"] + 1).alias("n_scored")

        def better(held: Column) -> Column:
            wins = (held["score"] > best["score"]) | ((held["score"] == best["score"]) & (o["id"] < best["id"]))
            return F.when(wins, F.struct(held["score"].alias("score"), o["id"].alias("id"), held["n_scored"].alias("n_scored"))).otherwise(
                F.struct(best["score"].alias("score"), best["id"].alias("id"), held["n_scored"].alias("n_scored"))
            )

        return let(F.struct(score, n), better)

    def step(best: Column, o: Column) -> Column:
        hopeless = (-o["less"] < best["score"]) | ((-o["less"] == best["score"]) & (o["id"] > best["id"]))
        return F.when(hopeless, best).otherwise(scored_option(best, o))

    return F.aggregate(F.array_sort(bounded), none, step)


def closest(
    records: DataFrame,
    candidates: DataFrame,
    bucket: str,
    record_text: str,
    candidate_id: str,
    candidate_text: str,
    scorer: Scorer,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """For each distinct `(bucket, record text)` its best candidate in the bucket.

    No candidate is dropped unless its bound shows that it cannot win; equal
    scores go to the lowest id. Gives `(bucket, record_text, score, match_id,
    n_candidates, n_scored)`, the last of which counts the pairs scored.
    """
    pairs = _chunk_pairs(records, candidates, bucket, record_text, candidate_id, candidate_text, scorer, bucket_rows)
    best = F.transform("asked", lambda r: F.struct(r["text"].alias("text"), _best_option(r["prepared"], F.col("options"), scorer).alias("best")))
    rows = pairs.select(bucket, "n_candidates", F.explode(best).alias("_r"))
    rank = F.struct(-F.col("_r.best.score"), F.col("_r.best.id"))
    return rows.groupBy(bucket, F.col("_r.text").alias(record_text)).agg(
        F.min_by("_r.best.score", rank).alias("score"),
        F.min_by("_r.best.id", rank).alias("match_id"),
        F.first("n_candidates").alias("n_candidates"),
        F.sum("_r.best.n_scored").alias("n_scored"),
    )


def all_scores(
    records: DataFrame,
    candidates: DataFrame,
    bucket: str,
    record_text: str,
    candidate_id: str,
    candidate_text: str,
    scorer: Scorer = TOKEN_SET,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """`(bucket, record_text, candidate_id, score)` of every distinct record text and candidate of its bucket.

    The score of a sole candidate is `SOLE_SCORE`, as where the best is chosen.
    """
    pairs = _chunk_pairs(records, candidates, bucket, record_text, candidate_id, candidate_text, scorer, bucket_rows)
    asked = pairs.select(bucket, "n_candidates", "options", F.explode("asked").alias("_r"))
    lone = F.col("n_candidates") == 1
    each = F.transform(
        "options",
        lambda o: F.struct(o["id"].alias("id"), F.when(lone, SOLE_SCORE).otherwise(scorer.score(F.col("_r.prepared"), o["prepared"])).alias("score")),
    )
    return asked.select(bucket, F.col("_r.text").alias(record_text), F.inline(each)).withColumnRenamed("id", candidate_id)


def match_names(
    records: DataFrame,
    candidates: DataFrame,
    bucket: str,
    name: str,
    minimum: float = MIN_NAME_SCORE,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Each record with the candidate name of its bucket that fits best.

    An equal name wins outright; what is left is scored, and scores below
    `minimum` give no match. Names come back day after day, so each pair of
    names is scored once, however many buckets it stands in, and not at all if
    its bound is below `minimum`. Records keep all their columns.
    """
    names = written(candidates.select(bucket, F.col(name).alias("_option")).distinct(), "options")
    asked = records.select(bucket, name).distinct()
    equal = names.select(bucket, F.col("_option").alias(name), F.lit(True).alias("_equal"))
    known = written(asked.join(equal, [bucket, name], "left"), "names")
    exact = known.where("_equal").select(bucket, name, F.col(name).alias("matched_name"), F.lit(100.0).alias("score"))
    met = spread_join(known.where("_equal is null").drop("_equal"), names, bucket, [name], bucket_rows=bucket_rows)
    scores = _name_scores(met.select(name, "_option").distinct(), name, minimum)
    rank = F.struct(-F.col("score"), F.col("_option"))
    found = met.join(scores, [name, "_option"]).groupBy(bucket, name).agg(
        F.min_by("_option", rank).alias("matched_name"), F.max("score").alias("score")
    )
    return records.join(exact.unionByName(found), [bucket, name])


def _name_scores(pairs: DataFrame, name: str, minimum: float) -> DataFrame:
    """The pairs of names that score `minimum` or more, with their scores."""

    def hopeful(pair: Column) -> Column:
        return F.when(NAME.bound(pair["a"], pair["b"]) >= minimum, NAME.score(pair["a"], pair["b"]))

    both = F.struct(NAME.prepare(F.col(name)).alias("a"), NAME.prepare(F.col("_option")).alias("b"))
    # written before it is filtered, or the filter would score once more
    scores = written(pairs.repartition(task_count(pairs)).select(name, "_option", let(both, hopeful).alias("score")), "name-scores")
    return scores.where(F.col("score") >= minimum)


def match_agendas(
    records: DataFrame,
    candidates: DataFrame,
    bucket: str,
    agenda: str,
    candidate_id: str,
    candidate_agenda: str,
    scorer: Scorer = TOKEN_SET,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Each record with the meeting of its bucket whose agenda fits best.

    A sole candidate is taken as it is; where nothing scores above zero there
    is no match. Adds `match_id`, `score` and `n_candidates`.
    """
    found = closest(records, candidates, bucket, agenda, candidate_id, candidate_agenda, scorer, bucket_rows).drop("n_scored")
    sole = F.col("n_candidates") == 1
    accepted = found.withColumn("score", F.when(sole, SOLE_SCORE).otherwise(F.col("score")))
    return records.join(accepted.where("score > 0"), [bucket, agenda])


def agenda_scores(pairs: DataFrame, left: str, right: str, scorer: Scorer = TOKEN_SET) -> DataFrame:
    """Adds the score of two text columns of the same row."""
    return pairs.withColumn("score", scored(scorer, F.col(left), F.col(right)))
