"""Captions, words, turns, sentences and transcript documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import segments as sg
from ..plans.gather import with_transcripts
from ..plans.transcribe import CaptionTranscripts, WordTranscripts
from ..sources.captions import cues as parse_cues
from ..sources.transcripts import known_format, raw_text
from .registry import load, load_wide, query

CUES = """SELECT conv_id, turn AS cue, CASE WHEN role = 'user' THEN 1 ELSE 0 END AS starts, text,
            turn * 5.0 AS start_time, turn * 5.0 + 4.5 AS end_time,
            CASE WHEN regexp_matches(text, '^[^\\n]+[.?!]\\s*$') THEN 1 ELSE 0 END AS closes FROM conversations"""
NUMBERED = f"""SELECT *, CAST(sum(starts) OVER (PARTITION BY conv_id ORDER BY cue) AS BIGINT) AS turn,
            CAST(sum(closes) OVER (PARTITION BY conv_id ORDER BY cue) - closes AS BIGINT) AS closed FROM ({CUES})"""
SENTENCES = f"""SELECT conv_id, turn, min(cue) AS first_cue,
            CAST(coalesce(min_by(start_time, cue) FILTER (WHERE start_time <> 0), 0) AS DOUBLE) AS start_time,
            CAST(max_by(end_time, cue) AS DOUBLE) AS end_time, string_agg(rtrim(text, ' '), ' ' ORDER BY cue) AS text
            FROM ({NUMBERED}) GROUP BY conv_id, turn, closed"""


def cues(spark, root):
    """Conversation turns as caption cues; a user's turn is a speaker change."""
    return load(spark, root, "conversations").select(
        "conv_id", F.col("turn").alias("cue"), (F.col("role") == "user").alias("starts_turn"), "text",
        (F.col("turn") * 5.0).alias("start_time"), (F.col("turn") * 5.0 + 4.5).alias("end_time"),
    )


def sentences(spark, root):
    return sg.sentences(sg.number_segments(cues(spark, root), "conv_id", "cue"), "conv_id", "cue")


@query("caption_cues", """
    SELECT conv_id || '-' || turn AS file, CAST(i - 1 AS INTEGER) AS cue_idx, (i - 1) * 2.0::DOUBLE AS start_time,
      (i - 1) * 2.0::DOUBLE + 1.5 AS end_time, lines[i] AS text
    FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM (
      SELECT conv_id, turn, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS lines FROM conversations))""")
def caption_cues(spark, root):
    lines = F.filter(F.split("text", "\n"), lambda line: F.trim(line) != "")

    def clock(seconds):
        # Two-digit fields of a running second.
        parts = [F.floor(seconds / 3600), F.floor(seconds / 60) % 60, F.floor(seconds) % 60]
        return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])

    blocks = F.transform(
        lines,
        lambda line, i: F.concat(
            clock(i * 2), F.lit(".000 --> "), clock(i * 2 + 1), F.lit(".500 align:start size:80%\n"), line
        ),
    )
    files = load(spark, root, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("file"),
        F.concat(F.lit("WEBVTT\n\n"), F.array_join(blocks, "\n\n")).alias("content"),
    )
    return parse_cues(files)


@query("transcript_raw_text", """
    SELECT conv_id, turn, role, replace(text, chr(10), ' ') AS raw FROM conversations""")
def transcript_raw_text(spark, root):
    """Each turn as a transcript whose format depends on the role."""
    turns = load(spark, root, "conversations")
    portions = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct((i * 1.0).alias("start_time"), line.alias("text"), (i + 1.0).alias("end_time")),
    )
    empty = F.slice(portions, 1, 0)
    flat = F.transform(
        portions,
        lambda p: F.struct(p.start_time.alias("start_time"), p.text.alias("text"), p.end_time.alias("end_time"),
                           F.lit(None).cast("string").alias("speaker"), empty.alias("data")),
    )
    spoken = F.transform(
        portions,
        lambda p: F.struct(F.lit(None).cast("double").alias("start_time"), F.lit(None).cast("string").alias("text"),
                           F.lit(None).cast("double").alias("end_time"), F.lit("").alias("speaker"),
                           F.array(p).alias("data")),
    )
    fmt = (
        F.when(F.col("role") == "user", "timestamped-speaker-turns")
        .when(F.col("role") == "assistant", "timestamped-sentences")
        .otherwise("raw")
    )
    documents = turns.select(
        "conv_id", "turn", "role", fmt.alias("format"),
        F.when(F.col("role") == "user", spoken).otherwise(flat).alias("data"),
    ).where(known_format(F.col("format")))
    return documents.select("conv_id", "turn", "role", raw_text(F.col("format"), F.col("data")).alias("raw"))


@query("speaker_turns", f"SELECT conv_id, cue, turn, closed, text FROM ({NUMBERED})")
def speaker_turns(spark, root):
    numbered = sg.number_segments(cues(spark, root), "conv_id", "cue")
    return numbered.select("conv_id", "cue", "turn", "closed", "text")


@query("marked_turns", """
    SELECT conv_id, turn, CAST(line AS INTEGER) AS line, starts_turn, CASE WHEN starts_turn THEN trim(text, ' ') ELSE text END AS text
    FROM (SELECT conv_id, turn, role = 'user' AS starts_turn, unnest(range(len(ls))) AS line, unnest(ls) AS text
          FROM (SELECT *, string_split(text, chr(10)) AS ls FROM conversations))""")
def marked_turns(spark, root):
    """Markers written in front of every line of user turns and taken off again."""
    lines = load(spark, root, "conversations").select("conv_id", "turn", "role", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    marked = F.when(F.col("role") == "user", F.concat(F.lit("- &gt;&gt; "), F.trim("text"))).otherwise(F.col("text"))
    return sg.mark_turns(lines.withColumn("text", marked), "&gt;").select("conv_id", "turn", "line", "starts_turn", "text")


@query("caption_sentences", SENTENCES)
def caption_sentences(spark, root):
    return sentences(spark, root)


@query("turn_documents", f"""
    SELECT conv_id, turn, first_cue // 10000 AS part, '' AS speaker, count(*) AS n_sentences,
      string_agg(text, '|' ORDER BY first_cue) AS texts, min_by(start_time, first_cue) AS start_time,
      max_by(end_time, first_cue) AS end_time FROM ({SENTENCES}) GROUP BY ALL""")
def turn_documents(spark, root):
    return sg.turn_documents(sentences(spark, root), "conv_id").select(
        "conv_id", "turn", "part", "speaker", F.size("data").cast("long").alias("n_sentences"),
        F.array_join("data.text", "|").alias("texts"), F.col("data")[0].start_time.alias("start_time"),
        F.element_at("data", -1).end_time.alias("end_time"),
    )


@query("transcript_document", f"""
    SELECT conv_id, 'timestamped-sentences' AS format, 0 AS n_annotations, 0.97::DOUBLE AS confidence,
      string_agg(text, '|' ORDER BY first_cue) AS texts
    FROM ({SENTENCES}) GROUP BY conv_id, first_cue // 10000""")
def transcript_document(spark, root):
    documents = sg.sentence_documents(sentences(spark, root), "conv_id")
    wrapped = sg.transcript_document(F.col("data"), "timestamped-sentences", F.lit(0.97))
    return documents.select("conv_id", wrapped.alias("d")).select(
        "conv_id", "d.format", F.size("d.annotations").alias("n_annotations"), "d.confidence",
        F.array_join("d.data.text", "|").alias("texts"),
    )


@query("derive_formats", f"""
    SELECT conv_id, first_cue // 10000 AS part, min_by(start_time, first_cue) AS start_time,
      string_agg(text, ' ' ORDER BY first_cue) AS text, max_by(end_time, first_cue) AS end_time
    FROM ({SENTENCES}) GROUP BY ALL""")
def derive_formats(spark, root):
    return sg.raw_portions(sentences(spark, root), "conv_id")


WORDS = """SELECT doc_id, word, text, word * 0.5 AS start_time, word * 0.5 + 0.25 AS end_time,
             CASE WHEN text LIKE '%.' THEN 1 ELSE 0 END AS closes
           FROM (SELECT doc_id, unnest(range(len(ws))) AS word, unnest(ws) AS text FROM (
             SELECT doc_id, list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda x: x <> '') AS ws FROM documents))"""
WORD_SENTENCES = f"""
    SELECT doc_id, CAST(sentence AS BIGINT) AS sentence, min(word) AS first_word, CAST(min_by(start_time, word) AS DOUBLE) AS start_time,
      CAST(max_by(end_time, word) AS DOUBLE) AS end_time, string_agg(text, ' ' ORDER BY word) AS text
    FROM (SELECT *, sum(closes) OVER (PARTITION BY doc_id ORDER BY word) - closes AS sentence FROM ({WORDS}))
    GROUP BY doc_id, sentence HAVING max(closes) = 1"""


def word_array():
    """The words of a text, half a second each."""
    tokens = F.filter(F.split(F.translate("text", "\n", " "), " "), lambda word: word != "")
    return F.transform(
        tokens, lambda word, i: F.struct(word.alias("text"), (i * 0.5).alias("start_time"), (i * 0.5 + 0.25).alias("end_time"))
    )


def word_files(spark, root):
    """Documents as files of recognised words."""
    return load_wide(spark, root, "documents").select("doc_id", word_array().alias("words"))


def words(spark, root):
    exploded = word_files(spark, root).select("doc_id", F.posexplode("words").alias("word", "_w"))
    return exploded.select("doc_id", F.col("word").cast("long").alias("word"), "_w.*")


@query("word_sentences", WORD_SENTENCES)
def word_sentences(spark, root):
    return sg.word_sentences(words(spark, root), "doc_id", "word")


@query("raw_from_words", f"""
    SELECT doc_id, first_word // 10000 AS part, 0.0::DOUBLE AS start_time, string_agg(text, ' ' ORDER BY first_word) AS text,
      last_end AS end_time
    FROM ({WORD_SENTENCES}) JOIN (SELECT doc_id, CAST(max(end_time) AS DOUBLE) AS last_end FROM ({WORDS}) GROUP BY doc_id) USING (doc_id)
    GROUP BY ALL""")
def raw_from_words(spark, root):
    return sg.raw_from_files(word_files(spark, root), "doc_id")


@query("flatten_words", f"""
    SELECT doc_id, CAST(word AS INTEGER) AS position, text, word + 0.25::DOUBLE AS start_time, word + 0.75::DOUBLE AS end_time
    FROM ({WORDS})""")
def flatten_words(spark, root):
    """One recogniser result per document, whose first alternative has its words."""
    tokens = F.filter(F.split(F.translate("text", "\n", " "), " "), lambda word: word != "")

    def moment(i, nanos):
        return F.struct(i.cast("long").alias("seconds"), F.lit(nanos).alias("nanos"))

    spoken = F.transform(
        tokens,
        lambda word, i: F.struct(
            word.alias("word"), moment(i, 250_000_000).alias("start_time"), moment(i, 750_000_000).alias("end_time")
        ),
    )
    other = F.slice(spoken, 1, 1)
    alternatives = F.array(F.struct(spoken.alias("words")), F.struct(other.alias("words")))
    results = load_wide(spark, root, "documents").select("doc_id", F.lit(0).alias("result"), alternatives.alias("alternatives"))
    return sg.flatten_words(results, "doc_id").drop("result")


@query("mean_confidence", """
    SELECT user_id, round(coalesce(avg(value) FILTER (WHERE event_type <> 'error'), 0), 6) AS confidence
    FROM events GROUP BY user_id""")
def mean_confidence(spark, root):
    segments = load(spark, root, "events").select(
        "user_id", "value", F.when(F.col("event_type") == "error", 0).otherwise(3).alias("n_words")
    )
    means = sg.mean_confidence(segments, "user_id", "value", "n_words")
    return means.select("user_id", F.round("confidence", 6).alias("confidence"))


@query("budgeted_prefix", """
    WITH f AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents),
    c AS (SELECT source, doc_id, regexp_replace(text[1:100], '(?s) [^ ]*$', '') AS phrase FROM f WHERE r <= 500),
    u AS (SELECT *, coalesce(sum(length(phrase)) OVER (PARTITION BY source ORDER BY doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM c)
    SELECT source, doc_id, phrase FROM u WHERE used <= 9900""")
def budgeted_prefix(spark, root):
    phrases = load_wide(spark, root, "documents").select("source", "doc_id", F.col("text").alias("phrase"))
    return sg.phrase_prefix(phrases, "source", "doc_id")


@query("source_fallback", """
    SELECT doc_id, coalesce(CASE WHEN quality = 1 THEN 'caption' END, 'speech') AS origin,
      coalesce(CASE WHEN quality = 1 THEN 0.97 END, 0.8)::DOUBLE AS confidence
    FROM documents LEFT JOIN labels USING (doc_id)""")
def source_fallback(spark, root):
    docs = load_wide(spark, root, "documents").select(
        "doc_id", F.col("doc_id").alias("caption_uri"), F.col("doc_id").alias("video_uri")
    )
    captioned = load(spark, root, "labels").where("quality = 1").select(
        F.col("doc_id").alias("caption_uri"), F.lit("caption").alias("transcript_uri"), F.lit(0.97).alias("confidence")
    )
    recognised = docs.select("video_uri", F.lit("speech").alias("transcript_uri"), F.lit(0.8).alias("confidence"))
    chosen = with_transcripts(docs, captioned, recognised)
    return chosen.select("doc_id", F.col("transcript_uri").alias("origin"), "confidence")


_SPACED = "regexp_replace(text, '([#$(<\\[{{]) ', ' \\1', 'g')".replace("{{", "{")


@query("transcripts_from_captions", f"""
    SELECT conv_id, first_cue // 10000 AS part, format, 0.97::DOUBLE AS confidence, string_agg({_SPACED}, ' ' ORDER BY first_cue) AS raw
    FROM ({SENTENCES}), (SELECT unnest(['timestamped-speaker-turns', 'timestamped-sentences', 'raw']) AS format) GROUP BY ALL""")
def transcripts_from_captions(spark, root):
    """Cues to turns, sentences and the three stored formats, each read back as text."""
    stored = CaptionTranscripts("conv_id", "cue", 0.97).transcripts(cues(spark, root))
    return stored.select("conv_id", "part", "format", "confidence", raw_text(F.col("format"), F.col("data")).alias("raw"))


@query("transcripts_from_words", f"""
    SELECT doc_id, first_word // 10000 AS part, format, string_agg({_SPACED}, ' ' ORDER BY first_word) AS raw
    FROM ({WORD_SENTENCES}), (SELECT unnest(['timestamped-sentences', 'raw']) AS format) GROUP BY ALL UNION ALL
    SELECT doc_id, word // 10000, 'timestamped-words', string_agg(text, ' ' ORDER BY word) FROM ({WORDS}) GROUP BY ALL""")
def transcripts_from_words(spark, root):
    """Recognised words to sentences and the three stored formats, each read back as text."""
    stored = WordTranscripts("doc_id", "word", 0.8).transcripts(word_files(spark, root))
    return stored.select("doc_id", "part", "format", raw_text(F.col("format"), F.col("data")).alias("raw"))
