import random

import pytest
from plain_stem import porter_stem
from conftest import one
from pyspark.sql import functions as F

from quorumlake.functions import text as tx
from quorumlake.functions import values as va
from quorumlake.functions.stem import IRREGULAR, STEP_2, STEP_3, STEP_4, stem
from quorumlake.operators.index import term_counts

# Cleaned and stemmed texts the index must agree with.
CLEANED = {
    "hello world": "hello world",
    "hello ": "hello",
    "the quick brown fox jumps over the running ant": "quick brown fox jump run ant",
    "thE quICk BROwn Fox JuMps OVER the RUNning ANt": "quick brown fox jump run ant",
    "1 billion": "1 billion",
    "98%": "98",
    "\n\n\n\nMEMORANDUM\n\nHello\n\tSPR": "memorandum hello spr",
    "1.4 Million": "14 million",
    "Will this remove punctuation?!%'": "remov punctuat",
    "$10 10.5% $5.5 2%": "10 105 55 2",
    "The study will reportedly cost $14.8 thousand": "studi reportedli cost 148 thousand",
}


def test_index_cleaner(spark):
    rows = spark.createDataFrame(list(CLEANED.items()), "text string, expected string")
    for row in rows.select(tx.clean_for_index(F.col("text")).alias("got"), "expected").collect():
        assert " ".join(porter_stem(t) for t in row.got.split(" ")) == row.expected


def test_stemmed_counts_agree_with_cleaner(spark):
    counts = term_counts(spark.createDataFrame(list(CLEANED.items()), "text string, expected string"), "expected")
    for row in counts.groupBy("expected").agg(F.collect_set("term").alias("terms")).collect():
        assert set(row.terms) == set(row.expected.split(" "))


def test_column_stems_equal_the_plain_ones(spark):
    random.seed(1)
    suffixes = [a for a, _ in STEP_2 + STEP_3] + [*STEP_4, *"s es ies ied ed ing eed y e ll ee sses ss yy yyy bl at iz".split(), ""]
    made = lambda: "".join(random.choices("aeiouybcdlstz", k=random.randint(0, 6))) + random.choice(suffixes)
    words = {made() + random.choice(["", "", "s", "ed", "ing", "ly"]) for _ in range(6000)} | set(IRREGULAR) | {"Y", "yyyyyy", "12_3", "été", ""}
    got = spark.createDataFrame([(w,) for w in words] + [(None,)], "term string").select("term", stem("term").alias("stem")).collect()
    assert {r["term"]: r["stem"] for r in got} == {w: porter_stem(w) for w in words} | {None: None}


def test_text_of_only_stop_words_has_no_terms(spark):
    assert one(spark, tx.clean_for_index(F.col("t")), t="the and, of!") is None


@pytest.mark.parametrize("text", ["don’t stop", "très s’il", "a-b the_x — to", "naïve the s"])
def test_stop_words_at_unicode_boundaries(spark, text):
    """Token by token gives what one pattern over the whole text gives."""
    whole = F.regexp_replace(F.col("t"), rf"(?U)\b(?:{'|'.join(tx.STOP_WORDS)})\b", "")
    assert one(spark, tx.remove_stop_words(F.col("t")), t=text) == one(spark, whole, t=text)


@pytest.mark.parametrize(
    "word, expected",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("feed", "feed"),
        ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"),
        ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"), ("fizzed", "fizz"),
        ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("skies", "sky"), ("dying", "die"),
        ("relational", "relat"), ("conditional", "condit"), ("vietnamization", "vietnam"),
        ("triplicate", "triplic"), ("electrical", "electr"), ("revival", "reviv"), ("adoption", "adopt"),
        ("controll", "control"), ("roll", "roll"), ("theology", "theolog"), ("generally", "gener"),
        ("is", "is"), ("enjoy", "enjoy"), ("news", "news"), ("died", "die"), ("spied", "spi"),
    ],
)
def test_stems(word, expected):
    assert porter_stem(word) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("hello world", "hello world"), (" hello world", "hello world"), ("hello world ", "hello world"),
        (" hello world ", "hello world"), ("hello world.", "hello world"), (" hello world. ", "hello world"),
        ("\n\t\t\t\xa0\xa0he\xa0ll\no \t\twor\xa0\nld\t", "hello world"),
        (" \n\t\t\t\xa0\xa0he\xa0ll\no \t\twor\xa0\nld\t. ", "hello world"), ("", ""),
    ],
)
def test_web_string(spark, text, expected):
    assert one(spark, tx.clean_web_string(F.col("t")), t=text) == expected


@pytest.mark.parametrize(
    "sibling, route, expected",
    [
        ("http://www.city.gov/Council", "images/a.jpg", "http://www.city.gov/images/a.jpg"),
        ("http://www.city.gov/Council/", "/images/a.jpg", "http://www.city.gov/images/a.jpg"),
        ("http://www.city.gov/Council/", "http://www.city.gov/a.jpg", "http://www.city.gov/a.jpg"),
    ],
)
def test_resolve_route(spark, sibling, route, expected):
    assert one(spark, tx.resolve_route(F.col("s"), F.col("r")), s=sibling, r=route) == expected


def test_agenda_names_and_symbols(spark):
    assert one(spark, tx.split_agenda(F.col("t")), t="Agenda: Public Comment; CB 999999.") == ["Public Comment", "CB 999999"]
    assert one(spark, tx.split_agenda(F.col("t")), t="Agenda Items: a, b") == ["a", "b"]
    assert one(spark, tx.normalize_name(F.col("t")), t="Parks\n - Special Meeting 12/04/19") == "Parks"
    assert one(spark, tx.fix_symbol_spacing(F.col("t")), t="roughly$ 19") == "roughly $19"
    assert one(spark, tx.clean_field(F.col("t")), t="a_\r\nb") == "ab"
    assert one(spark, tx.truncate(F.col("t")), t="x" * 801) == "x" * 800 + "..."
    assert one(spark, tx.truncate(F.col("t")), t="x" * 800) == "x" * 800


def test_uris(spark):
    assert one(spark, tx.content_path(F.lit("abcd"), F.lit("f.txt"))) == "ab/cd/f.txt"
    assert one(spark, tx.uri_suffix(F.col("u")), u="http://a.b/c.d/name") == ""
    assert one(spark, tx.content_type(F.lit("mp4"))) == "video/mp4"
    assert one(spark, tx.content_type(F.lit("zip"))) is None
    for uri, local in [("http://a", False), ("https://a", False), ("gc://a", False), ("s3://a", False), ("/a/b", True)]:
        assert one(spark, tx.is_local_uri(F.col("u")), u=uri) is local


def test_values(spark):
    assert one(spark, va.index_or_default(F.lit(0))) == -1
    assert one(spark, va.index_or_default(F.lit(None))) == -1
    assert one(spark, va.index_or_default(F.lit(7))) == 7
    assert one(spark, va.parse_month_day_year(F.lit("12/4/2019"))).isoformat() == "2019-12-04T00:00:00"
    assert one(spark, va.parse_month_day_year(F.lit("soon"))) is None
    stamp = va.parse_date_and_clock(F.lit("2019-12-04T00:00:00"), F.lit("1:30 PM"))
    assert one(spark, stamp).isoformat() == "2019-12-04T13:30:00"
    frame = spark.createDataFrame([(1, 1.0, "a", [1])], "i int, d double, s string, l array<int>")
    tags = frame.select(*[va.type_tag(frame, c) for c in frame.columns]).first()
    assert list(tags) == ["INTEGER", "DOUBLE", "STRING", "array<int>"]
    assert frame.select(va.as_stored_text(frame, "l")).first()[0] == "[1]"
