import math
import random

import pytest
from plain_similarity import name_score, token_jaccard, token_set_score
from pyspark.sql import functions as F

from quorumlake.catalog import meetings
from quorumlake.functions import similarity
from quorumlake.operators import index as ix
from quorumlake.operators import match as ma
from quorumlake.operators import search as se
from quorumlake.operators import segments as sg
from quorumlake.operators import select as sel
from quorumlake.operators import spans as sp
from quorumlake.operators import spread as sd
from quorumlake.operators import store as st
from quorumlake.operators.manifest import best_transcripts
from quorumlake.operators.truecase import apply_casing, fit_casing, placed_tokens
from quorumlake.plans.transcribe import WordTranscripts


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_conditions_and_orders(spark):
    equal = sel.Where("uri", "==", "x")
    for form in (("uri", "x"), ["uri", "x"], ("uri", "==", "x"), ["uri", "==", "x"], equal):
        assert sel.where(form) == equal
    for form in ("uri", ["uri"], ("uri", True), ("uri", "DESCENDING"), sel.OrderBy("uri")):
        assert sel.order_by(form) == sel.OrderBy("uri", True)
    for build in (sel.where, sel.order_by):
        with pytest.raises(sel.UnknownConditionError):
            build({"bad", "type"})
        with pytest.raises(sel.MalformedConditionError):
            build((1, 2, 3, 4))
    with pytest.raises(ValueError, match="unknown operator"):
        sel.predicate(spark.range(1), ("id", "~", 1))


def test_null_safe_filters(spark):
    names = spark.createDataFrame([("a",), ("b",), (None,)], "name string")
    assert rows(names.where(sel.not_ignored(F.col("name"), ["a"])).where("name is not null")) == [("b",)]
    assert names.where(sel.not_ignored(F.col("name"), ["a"])).count() == 2
    assert rows(names.where(sel.not_ignored(F.col("name"), ["a", None]))) == [("b",)]
    assert names.where(sel.not_status(F.col("name"), "a")).count() == 2
    assert rows(sel.select_rows(names, [("name", None)])) == [(None,)]


TERMS = "But I don't think the barrier is so high to allow individuals to use the service.".split(" ")
OPEN = "This is a sentence with no end of sentence punctuation but really why would someone do this".split(" ")

# Terms, position and the span around it.
SPANS = [
    ("Hello and good morning.".split(" "), 0, "Hello and good morning."),
    (TERMS, 0, "But I don't think the barrier is so high to ..."),
    (TERMS, 6, "... I don't think the barrier is so high to allow ..."),
    (TERMS, 15, "... is so high to allow individuals to use the service."),
    (OPEN, 0, "This is a sentence with no end of sentence punctuation ..."),
    (OPEN, 7, "... a sentence with no end of sentence punctuation but really ..."),
    (OPEN, 15, "... of sentence punctuation but really why would someone do this"),
    ("four words no punctuation".split(" "), 2, "four words no punctuation"),
    ("four words. yes punctuation".split(" "), 1, "four words."),
    ("four words. yes punctuation".split(" "), 3, "yes punctuation"),
]


def test_context_span(spark):
    given = spark.createDataFrame(SPANS, "terms array<string>, i int, expected string")
    for row in given.select(sp.context_span(F.col("terms"), F.col("i")).alias("got"), "expected").collect():
        assert row.got == row.expected
    for bad in (-1, 16):
        with pytest.raises(Exception, match="no term at position"):
            spark.createDataFrame([(TERMS, bad)], "terms array<string>, i int").select(
                sp.context_span(F.col("terms"), F.col("i"))
            ).collect()


def test_all_spans_agree_with_single_spans(spark):
    random.seed(3)
    words = ["a", "bb.", "c", "", "dd", "what?", "e"]
    docs = [(i, " ".join(random.choices(words, weights=[5, 1, 5, 1, 5, 1, 5], k=random.randint(1, 40)))) for i in range(60)]
    frame = spark.createDataFrame(docs, "id int, text string")
    split = frame.select("id", F.split("text", " ").alias("terms"))
    single = split.select("id", "terms", F.posexplode("terms").alias("i", "term")).select(
        "id", "term", sp.context_span(F.col("terms"), F.col("i")).alias("span")
    )
    assert rows(sp.all_spans(frame, "id").select("id", "term", "span")) == rows(single)


def test_tfidf_and_search(spark):
    docs = spark.createDataFrame(
        [("a", "Hello world, my name is Jackson."), ("b", "Hello world, on the internet I generally go by Maxfield."), ("c", "the of!")],
        "doc string, text string",
    )
    index = ix.tfidf(ix.term_counts(docs, "doc"), "doc")
    values = {(r.term, r.doc): r.value for r in index.collect()}
    assert values[("hello", "a")] == values[("world", "b")] == 0.0
    for term, doc in [("name", "a"), ("jackson", "a"), ("internet", "b"), ("gener", "b"), ("go", "b"), ("maxfield", "b")]:
        assert values[(term, doc)] == pytest.approx(math.log(2))
    assert {t for t, _ in values} == {"hello", "world", "name", "jackson", "internet", "gener", "go", "maxfield"}
    assert ix.TfidfIndexer("doc").build(docs).count() == 6
    assert se.search_text(index, "the", "doc").count() == 0


def test_search_relevance(spark):
    index = spark.createDataFrame([("hello", 123, 0.2), ("hello", 234, 0.4), ("world", 234, 0.4)], "term string, id int, value double")
    found = se.search_text(index, "Hello, world! hello", "id").collect()
    assert [(r.id, round(r.relevance, 6)) for r in found] == [(234, 0.8), (123, 0.2)]
    assert [(t.term, t.contribution) for t in found[0].terms] == [("hello", 0.4), ("world", 0.4)]
    data = spark.createDataFrame([(123, "x")], "id int, title string")
    attached = se.attach_rows(se.search_text(index, "hello world", "id"), data, "id")
    assert {r.id: r.data and r.data.title for r in attached.collect()} == {123: "x", 234: None}


def test_prune_counts_dropped(spark):
    from pyspark.sql import Observation

    index = spark.createDataFrame([("a", 1, 0.0), ("b", 1, 0.5)], "term string, id int, value double")
    seen = Observation()
    assert ix.prune(index, 0.0, seen).count() == 1
    assert seen.get["dropped"] == 1


@pytest.mark.parametrize("bucket_rows", [5, 10_000_000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_agrees_with_join(spark, bucket_rows, how):
    """A third of the rows has one key; splitting it changes nothing."""
    random.seed(1)
    left = spark.createDataFrame(
        [(i, "hot" if i % 3 == 0 else f"k{random.randint(0, 40)}") for i in range(600)] + [(1000, None)], "id int, key string"
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(20)], "key string, v int")
    got = sd.spread_join(left, right, "key", ["id"], how=how, bucket_rows=bucket_rows).select("key", "id", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, left.join(right, "key", how).select("key", "id", "v").collect()))


def test_spread_join_splits_any_number_of_keys(spark):
    left = spark.range(12_000).select("id", (F.col("id") % 1500).alias("key"))
    right = spark.range(1500).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    got = sd.spread_join(left, right, "key", ["id"], bucket_rows=3)
    assert got.count() == 12_000 and got.where("v <> key * 2").isEmpty()


@pytest.mark.parametrize("block", [3, 1000])
def test_running_totals(spark, block):
    random.seed(2)
    data = [("hot" if k < 40 else f"f{k % 3}", k, random.randint(0, 1)) for k in range(120)]
    got = sd.running_totals(spark.createDataFrame(data, "f string, n int, x int"), ["f"], "n", {"s": F.col("x")}, block)
    for row in got.collect():
        assert row.s == sum(x for f, n, x in data if f == row.f and n <= row.n)


def caption_rows(spark, texts):
    return spark.createDataFrame([("f", i, t, float(i), i + 0.5) for i, t in enumerate(texts)],
                                 "file string, cue int, text string, start_time double, end_time double")


# Cue texts and the sentences of each speaker turn.
TURNS = [
    (["&gt;&gt; Start of Dialog 1.", "End of Dialog 1.", "&gt;&gt; [ APPLAUSE ]", "&gt;&gt; Dialog 2."],
     [["Start of Dialog 1.", "End of Dialog 1."], ["[ APPLAUSE ]"], ["Dialog 2."]]),
    (["&gt;&gt; [ LAUGHTER ] Dialog 1.", "&gt;&gt; [ APPLAUSE ]", "&gt;&gt; Dialog 2."],
     [["[ LAUGHTER ] Dialog 1."], ["[ APPLAUSE ]"], ["Dialog 2."]]),
    (["&gt;&gt; Sentence", "one.", "&gt;&gt; Sentence", "two!", "Sentence", "three!", "Sentence", "four?"],
     [["Sentence one."], ["Sentence two!", "Sentence three!", "Sentence four?"]]),
    (["&gt;&gt; Sentence", "one, no sentence ending punctuation", "&gt;&gt; Sentence", "two."],
     [["Sentence one, no sentence ending punctuation"], ["Sentence two."]]),
    (["Sentence one.", "ú&gt;&gt; Sentence two."], [["Sentence one."], ["Sentence two."]]),
]


@pytest.mark.parametrize("texts, expected", TURNS)
def test_turns_and_sentences(spark, texts, expected):
    marked = sg.mark_turns(caption_rows(spark, texts), "&gt;&gt;")
    sentences = sg.sentences(sg.number_segments(marked, "file", "cue"), "file", "cue")
    documents = sg.turn_documents(sentences, "file").orderBy("turn", "part").collect()
    assert [[p.text for p in d.data] for d in documents] == expected
    raw = sg.raw_portions(sentences, "file").first()
    assert raw.text == " ".join(s for turn in expected for s in turn)


def test_sentence_start_skips_zero(spark):
    marked = sg.mark_turns(caption_rows(spark, ["one", "two."]), "&gt;")
    row = sg.sentences(sg.number_segments(marked, "file", "cue"), "file", "cue").first()
    assert (row.start_time, row.end_time, row.text) == (1.0, 1.5, "one two.")


def test_sentences_over_block_borders(spark, monkeypatch):
    """Blocks of two cues give the sentences one block gives."""
    texts = ["a", "b", "c.", "&gt; d", "e", "f", "g!", "h", "i"]
    whole = sg.sentences(sg.number_segments(sg.mark_turns(caption_rows(spark, texts), "&gt;"), "file", "cue"), "file", "cue")
    expected = rows(whole)
    monkeypatch.setattr(sg, "running_totals", lambda *a: sd.running_totals(*a, block_rows=2))
    parted = sg.sentences(sg.number_segments(sg.mark_turns(caption_rows(spark, texts), "&gt;"), "file", "cue"), "file", "cue")
    assert rows(parted) == expected


def test_word_sentences(spark):
    spoken = "Hello everyone and thank you for coming. Will the clerk begin by taking roll. and so".split(" ")
    words = spark.createDataFrame([("f", i, w, i * 1.0, i + 0.5) for i, w in enumerate(spoken)],
                                  "file string, n int, text string, start_time double, end_time double")
    sentences = sg.word_sentences(words, "file", "n")
    got = [(r.text, r.start_time, r.end_time) for r in sentences.orderBy("first_word").collect()]
    assert got == [("Hello everyone and thank you for coming.", 0.0, 6.5), ("Will the clerk begin by taking roll.", 7.0, 13.5)]
    assert sg.word_sentences(words, "file", "n", keep_tail=True).count() == 3
    raw = sg.raw_from_words(words, sentences, "file", "n").first()
    assert (raw.start_time, raw.end_time) == (0.0, 15.5)
    assert raw.text.endswith("taking roll.")


PHRASE = "this will be chunked to less than one hundred characters because that is the maximum allowed by google cloud speech recognition"


@pytest.mark.parametrize(
    "phrases, expected",
    [
        ([], []),
        ([str(i) for i in range(600)], [str(i) for i in range(500)]),
        ([PHRASE], [PHRASE[:95]]),
        (["-" * 100] * 200, ["-" * 100] * 100),
        (["hello world", None], ["hello"]),
    ],
)
def test_phrase_prefix(spark, phrases, expected):
    frame = spark.createDataFrame([("k", i, p) for i, p in enumerate(phrases)], "key string, n int, phrase string")
    assert [r.phrase for r in sg.phrase_prefix(frame, "key", "n").orderBy("n").collect()] == expected


def test_scores():
    assert token_set_score("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert token_set_score("", "a") == 0 and name_score(None, "a") == 0
    assert name_score("this is a test", "this is a test!") == 100
    assert name_score("Parks Committee", "parks committee") == 100
    assert name_score("abcd", "wxyz") == 0
    # The two spaces are what the five-character texts share.
    assert token_set_score("a b c", "d e f") == 40
    assert name_score("Council", "City Council of the Whole") == pytest.approx(90)


def _score_pairs():
    random.seed(3)
    words = ["Parks", "Finance", "Budget", "Committee", "on", "Levy", "of", "the", "Whole", "é日x", "a"]
    name = lambda k: " ".join(random.choices(words, k=random.randint(0, k)))
    pairs = [(name(5), name(7)) for _ in range(150)] + [(None, "a"), ("", "a"), ("!!", "b"), ("a", "a"), ("É_x", "é x")]
    noise = lambda: "".join(random.choices("ab cd", k=random.randint(0, 260)))
    return pairs, pairs + [(noise(), noise()) for _ in range(60)]


def test_column_scores_equal_the_plain_ones_and_stay_under_their_bounds(spark):
    names, texts = _score_pairs()
    for scorer, plain, pairs in ((similarity.TOKEN_SET, token_set_score, texts), (similarity.NAME, name_score, names)):
        frame = spark.createDataFrame(pairs, "a string, b string").repartition(4)
        both = F.struct(scorer.prepare(F.col("a")).alias("a"), scorer.prepare(F.col("b")).alias("b"))
        bound = similarity.let(both, lambda q: scorer.bound(q["a"], q["b"]))
        for r in frame.select("a", "b", similarity.scored(scorer, F.col("a"), F.col("b")).alias("score"), bound.alias("bound")).collect():
            assert r["score"] == pytest.approx(plain(r["a"], r["b"])) and r["bound"] >= r["score"] - 1e-9


def test_common_length_beyond_one_mask(spark):
    random.seed(4)
    text = lambda n: "".join(random.choices("abc", k=n))
    pairs = [(text(n), text(m)) for n in (0, 1, 61, 62, 63, 124, 125, 200) for m in (0, 5, 62, 190)] + [("a" * 130, "a" * 62)]
    got = spark.createDataFrame(pairs, "a string, b string").withColumn("n", similarity.common_length(F.col("a"), F.col("b"))).collect()
    for r in got:
        row = [0] * (len(r["a"]) + 1)
        for ch in r["b"]:
            before = row[:]
            for i, x in enumerate(r["a"]):
                row[i + 1] = before[i] + 1 if x == ch else max(before[i + 1], row[i])
        assert r["n"] == row[-1]


def test_every_candidate_gets_a_score_and_hopeless_ones_are_not_scored(spark, monkeypatch):
    monkeypatch.setattr(ma, "BLOCK", 8)
    random.seed(6)
    words = ["budget", "parks", "levy", "zoning", "transit", "housing", "water", "light", "police", "library"]
    text = lambda: " ".join(random.choices(words, k=6))
    options = [("hot", i, text()) for i in range(30)] + [("lone", 99, "x")]
    records = [("hot", i, options[3 * i][2] + " levy" if i % 2 else text()) for i in range(10)] + [("lone", 50, "y"), ("none", 51, "z")]
    asked = spark.createDataFrame(records, "day string, id int, agenda string")
    held = spark.createDataFrame(options, "day string, option int, items string")
    scores = ma.all_scores(asked, held, "day", "agenda", "option", "items").collect()
    plain = {(d, a, o): token_set_score(a, t) for d, _, a in records for e, o, t in options if d == e and d == "hot"} | {("lone", "y", 99): 100.0}
    assert {(r["day"], r["agenda"], r["option"]): pytest.approx(r["score"]) for r in scores} == plain and len(scores) == len(plain)
    best = ma.closest(asked, held, "day", "agenda", "option", "items", similarity.TOKEN_SET).collect()
    for r in best:
        if r["day"] == "hot":
            ranked = min((-s, o) for (d, a, o), s in plain.items() if (d, a) == ("hot", r["agenda"]))
            assert (pytest.approx(-r["score"]), r["match_id"]) == ranked
    assert sum(r["n_scored"] for r in best) < 0.8 * len(plain)


@pytest.mark.parametrize("bucket_rows", [2, 10_000_000])
def test_closest_agrees_with_brute_force(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(ma, "BLOCK", 4)
    random.seed(5)
    words = ["budget", "parks", "levy", "zoning", "transit", "housing", "water"]
    text = lambda: " ".join(random.choices(words, k=4))
    records = [("hot" if i % 2 else f"d{i % 3}", i, text()) for i in range(40)]
    options = [("hot" if i % 3 else f"d{i % 2}", i, text()) for i in range(50)]
    got = ma.match_agendas(
        spark.createDataFrame(records, "day string, id int, agenda string"),
        spark.createDataFrame(options, "day string, option int, items string"),
        "day", "agenda", "option", "items", similarity.JACCARD, bucket_rows,
    )
    expected = set()
    for day, key, agenda in records:
        scored = [(-token_jaccard(agenda, items), option) for d, option, items in options if d == day]
        if len(scored) == 1:
            expected.add((key, scored[0][1], 100.0))
        elif scored and min(scored)[0] < 0:
            expected.add((key, min(scored)[1], round(-min(scored)[0], 9)))
    assert {(r.id, r.match_id, round(r.score, 9)) for r in got.collect()} == expected


def test_match_names(spark):
    records = spark.createDataFrame(
        [(1, "d", "Parks Committee"), (2, "d", "Park Committee"), (3, "d", "zzzz qqqq"), (4, "e", "Parks Committee")],
        "id int, day string, body string",
    )
    options = spark.createDataFrame([("d", "Parks Committee"), ("d", "Finance and Budget")], "day string, body string")
    got = {r.id: (r.matched_name, r.score) for r in ma.match_names(records, options, "day", "body").collect()}
    assert got[1] == ("Parks Committee", 100.0)
    assert got[2][0] == "Parks Committee" and 90 < got[2][1] < 100
    assert set(got) == {1, 2}


@pytest.mark.parametrize("bucket_rows", [2, 10_000_000])
def test_match_names_agrees_with_brute_force(spark, monkeypatch, bucket_rows):
    """Half of all names fall on one day, in blocks of three candidates."""
    monkeypatch.setattr(ma, "BLOCK", 3)
    random.seed(8)
    parts = ["Parks", "Finance", "Budget", "Select", "Committee", "on", "Levy", "Council"]
    name = lambda k: " ".join(random.sample(parts, k))
    records = [(i, "hot" if i % 2 else f"d{i % 3}", name(3)) for i in range(30)]
    options = [("hot" if i % 2 else f"d{i % 3}", name(random.randint(2, 4))) for i in range(30)]
    got = ma.match_names(
        spark.createDataFrame(records, "id int, day string, body string"),
        spark.createDataFrame(options, "day string, body string"), "day", "body", bucket_rows=bucket_rows,
    )
    expected = set()
    for key, day, body in records:
        names = {b for d, b in options if d == day}
        if body in names:
            expected.add((key, body, 100.0))
        elif names:
            score, best = min((-name_score(body, b), b) for b in names)
            if -score >= 50:
                expected.add((key, best, round(-score, 9)))
    assert {(r.id, r.matched_name, round(r.score, 9)) for r in got.collect()} == expected


def test_interval_join_is_half_open(spark):
    records = spark.sql("select 1 as id, timestamp'2024-01-01 00:00:00' as t union all select 2, timestamp'2024-01-01 10:00:00'")
    held = spark.sql("select explode(array(timestamp'2024-01-01 00:00:00', timestamp'2024-01-02 00:00:00')) as m")
    got = [(r.id, r.m.day) for r in ma.interval_join(records, "t", held, "m").orderBy("id").collect()]
    assert got == [(1, 1), (2, 2)]


def test_insert_if_absent_is_idempotent(spark):
    stored = spark.createDataFrame([("a", None, 1)], "name string, email string, v int")
    batch = spark.createDataFrame([("a", None, 2), ("a", "x", 3), ("a", "x", 4), ("b", "", 5), ("b", None, 6)], stored.schema)
    new = st.insert_if_absent(stored, batch, ["name", "email"], F.col("v"))
    assert rows(new.select("v")) == [(3,), (5,), (6,)]
    assert st.insert_if_absent(stored.unionByName(new), batch, ["name", "email"], F.col("v")).count() == 0


def test_keys_tell_null_from_empty(spark):
    frame = spark.createDataFrame([("a", None), ("a", "")], "n string, e string")
    assert frame.select(st.surrogate_key("person", "n", "e")).distinct().count() == 2


def test_uniqueness(spark):
    frame = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(st.UniquenessError) as caught:
        st.require_unique(frame, "body", ["k"])
    assert caught.value.row == {"k": 1, "n_rows": 2}
    assert len(caught.value.rows) == 2
    assert st.require_unique(frame, "body", ["k"], 2) is frame


def test_upsert_keeps_ids(spark):
    schema = "entry_id string, term string, doc int, value double, updated string"
    stored = spark.createDataFrame([("old1", "a", 1, 1.0, "t1"), ("old2", "b", 1, 2.0, "t1")], schema)
    new = spark.createDataFrame([("new1", "a", 1, 9.0, "t2"), ("new3", "c", 1, 3.0, "t2")], schema)
    got = {r.term: (r.entry_id, r.value, r.updated) for r in ix.upsert(stored, new, ["term", "doc"], "entry_id").collect()}
    assert got == {"a": ("old1", 9.0, "t2"), "b": ("old2", 2.0, "t1"), "c": ("new3", 3.0, "t2")}


def test_manifest_order_field_is_checked(spark):
    with pytest.raises(ValueError, match="ordered by"):
        best_transcripts(spark.range(1), "title")


def test_truecase(spark):
    corpus = spark.createDataFrame([(1, "we met Denver folks. the Denver mayor spoke to us")], "id int, text string")
    model = fit_casing(placed_tokens(corpus, "id"))
    shouted = placed_tokens(spark.createDataFrame([(7, "THE MAYOR OF DENVER SPOKE. WE LEFT")], "id int, text string"), "id")
    assert apply_casing(shouted, model, "id").first().text == "The mayor of Denver spoke. We left"


def test_scratch_removes_its_tables_also_on_failure(spark):
    from pathlib import Path

    from quorumlake.session import scratch, work_path, written

    def there(path):
        return Path(path.removeprefix("file:")).exists()

    with scratch(spark):
        outer = work_path(spark, "outer")
        spark.range(3).write.parquet(outer)
        with pytest.raises(ValueError), scratch(spark):
            inner = work_path(spark, "inner")
            spark.range(3).write.parquet(inner)
            assert written(spark.range(5), "table").count() == 5
            raise ValueError
        assert not there(inner) and there(outer)
    assert not there(outer)


def test_numbered_matches_follow_relevance_and_lowest_id(spark):
    from quorumlake.operators.search import numbered

    rows = [(2, 1, 5.0), (1, 9, 1.0), (1, 3, 7.0), (1, 2, 7.0)]
    found = numbered(spark.createDataFrame(rows, "q int, d int, relevance double"), "q", "d")
    assert sorted((r.position, r.q, r.d) for r in found.collect()) == [(1, 1, 2), (2, 1, 3), (3, 1, 9), (4, 2, 1)]
    assert numbered(found.drop("position").where("q = 7"), "q", "d").isEmpty()


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("frequent", [1, 3, 10_000])
def test_weights_are_the_same_whichever_terms_are_broadcast(spark, monkeypatch, frequent):
    monkeypatch.setattr(ix, "FREQUENT_TERMS", frequent)
    held = {(f"d{i}", t): i % 3 + 1 for i in range(12) for t in ["all", *(["third"] if i % 3 == 0 else []), f"own{i}"]}
    counts = spark.createDataFrame([(d, t, n) for (d, t), n in held.items()], "doc string, term string, n long")
    got = {(r.doc, r.term): r.value for r in ix.tfidf(counts, "doc").collect()}
    df = {t: sum(u == t for _, u in held) for _, t in held}
    assert got == pytest.approx({(d, t): n * math.log(12 / df[t]) for (d, t), n in held.items()})


def test_stems_are_the_same_whichever_terms_are_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"running runs bikes bike{'s' * (i % 2)} word{i}ing") for i in range(8)], "doc int, text string")
    whole = rows(ix.term_counts(docs, "doc"))
    monkeypatch.setattr(ix, "FREQUENT_TERMS", 4)
    assert rows(ix.term_counts(docs, "doc")) == whole


def test_counts_of_a_corpus_dealt_by_id_move_no_rows(spark):
    docs = spark.createDataFrame([(1, 0, "a bike"), (1, 1, "bike lane"), (2, 0, None)], "id int, part int, text string")
    counts = ix.term_counts(docs.repartition("id"), ["id", "part"], stemmed=False)
    assert _plan(counts).count("Exchange") == 1
    assert rows(counts) == [(1, 0, "bike", 1), (1, 1, "bike", 1), (1, 1, "lane", 1)]


def test_search_moves_entries_and_not_matches(spark):
    index = spark.createDataFrame([(f"t{j}", i, float(j + 1)) for i in range(9) for j in range(4)], "term string, id int, value double")
    queries = spark.createDataFrame([(q, f"t{q % 4} t{(q + 1) % 4} none") for q in range(20)], "q int, text string")
    found = se.search(index, queries, "q", "id", stemmed=False)
    assert "Exchange hashpartitioning(q" not in _plan(found)
    expected = sorted((q, i, float(q % 4 + (q + 1) % 4 + 2)) for q in range(20) for i in range(9))
    assert rows(found.select("q", "id", "relevance")) == expected


def test_entries_of_some_terms_are_those_of_the_whole_index(spark):
    docs = spark.createDataFrame(
        [(1, "ore bike"), (2, "ore ore"), (2, "lane"), (3, "the"), (4, None), (5, "lane")], "id int, text string"
    )
    whole = ix.tfidf(ix.term_counts(docs, "id", stemmed=False), "id")
    assert rows(ix.term_entries(docs, "id", ["ore"])) == rows(whole.where("term = 'ore'"))


def test_upsert_with_derived_ids_equals_ids_sent_along(spark):
    stored = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 1)], "k string, value double, updated int")
    new = spark.createDataFrame([("b", 5.0, 2), ("c", 6.0, 2)], "k string, value double, updated int")
    entry = st.surrogate_key("t", "k")
    sent = ix.upsert(stored.withColumn("id", entry), new.withColumn("id", entry), ["k"], "id")
    assert rows(ix.upsert(stored, new, ["k"], "id", derived=entry)) == rows(sent)


def test_latest_counts_leave_out_replaced_parts_only(spark):
    counts = spark.createDataFrame(
        [(0, 1, 0, "old", 1), (1, 1, 0, "new", 2), (0, 1, 1, "new", 3), (0, 2, 0, "old", 4), (0, None, 0, "x", 1), (0, 3, None, "x", 1)],
        "batch long, id int, part int, term string, n long",
    )
    assert rows(ix.latest_counts(counts, "id", "part")) == [(1, "new", 5), (2, "old", 4)]


def test_files_of_words_stay_in_their_row(spark):
    """Files as arrays give what their words give as rows, and only those that must are moved."""
    texts = [(1, "a b. c. d"), (2, "no end"), (3, " ".join(f"w{i}{'.' * (i % 3000 == 2999)}" for i in range(12_000))), (4, "x y."), (4, "z. q."), (None, "n."), (5, None), (6, "a $ 5.")]
    rows = [(k, None if t is None else [(w, i * 0.5, i * 0.5 + 0.25) for i, w in enumerate(t.split(" "))]) for k, t in texts]
    files = spark.createDataFrame(rows, "file long, words array<struct<text: string, start_time: double, end_time: double>>")
    words = files.select("file", F.posexplode("words").alias("word", "w")).select("file", F.col("word").cast("long").alias("word"), "w.*")
    alone, moved = sg.split_files(files, "file")
    assert sorted(r.file for r in alone.where("words is not null").collect()) == [1, 2, 6]
    assert {r.file for r in moved.select("file").distinct().collect()} == {None, 3, 4}

    def held(df):
        return sorted(map(repr, df.collect()))

    expected = sg.raw_from_words(words, sg.word_sentences(words, "file", "word"), "file", "word")
    assert held(sg.raw_from_files(files, "file")) == held(expected)
    transcribed = WordTranscripts("file", "word", 0.8)
    assert held(transcribed.transcripts(files)) == held(transcribed.transcripts(words))


def test_lopsided_token_sets_need_no_common_subsequence(spark):
    """Where the shorter side cannot win, the score is that of the shared words; it is the plain score either way."""
    pairs = [("a b c d e f x", "a b c d e f " + "long words " * 20), ("the budget vote", "budget and the vote of a much longer agenda text")]
    rows = spark.createDataFrame(pairs, "a string, b string")
    got = rows.select("a", "b", similarity.token_set_score(F.col("a"), F.col("b")).alias("ab"), similarity.token_set_score(F.col("b"), F.col("a")).alias("ba")).collect()
    for r in got:
        assert r.ab == pytest.approx(token_set_score(r.a, r.b)) and r.ba == pytest.approx(r.ab)
    both = F.struct(similarity.prepared(F.col("a")).alias("a"), similarity.prepared(F.col("b")).alias("b"))
    never = lambda a, b: F.raise_error(F.concat(F.lit("compared "), a)).cast("int")
    alone = similarity.let(both, lambda p: similarity._token_set(p["a"], p["b"], never))
    assert rows.limit(1).select(alone.alias("s")).first().s == pytest.approx(token_set_score(*pairs[0]))


def test_the_shorter_text_is_tabled(spark, monkeypatch):
    tabled = []
    places = similarity.places
    monkeypatch.setattr(similarity, "places", lambda text: tabled.append(text) or places(text))
    a, b = "the council", "the clerk of the council will call the roll of members present and absent"
    rows = spark.createDataFrame([(a, b), (b, a), ("", a)], "a string, b string")
    assert [r.n for r in rows.select(similarity.common_length(F.col("a"), F.col("b")).alias("n")).collect()] == [11, 11, 0]
    assert "short" in str(tabled[0])


def test_votes_move_with_their_item(spark, tmp_path):
    """The rows of an item's votes are dealt by item alone; of the votes of a person on an item the first counts."""
    docs = [(1, "ann bob ann\nx", "s", 13), (2, "ann bob ann\nx", "s", 13)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    votes = meetings.star(spark, str(tmp_path))["vote"]
    plan = votes._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(event_minutes_item_id" in plan and "hashpartitioning(person_id" not in plan
    got = sorted((r.legistar_event_item_vote_id, r.decision) for r in votes.collect())
    assert got == [(10_000_000_000, "In Favor"), (10_000_000_001, "Opposed"), (10_000_000_002, "Opposed")]
    assert votes.select("vote_id").distinct().count() == 3


def test_counts_inside_rows_add_up_to_term_counts(spark):
    texts = ["the Bike bike, bike", "", None, "of the", "caf\u00e9 the\u00a0ore ore\u2019s\tore\nlane", "a\x07the b\rthe x_y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    counted = ix.row_counts(docs, "id")
    assert [r.id for r in counted.where("terms = array()").orderBy("id").collect()] == [1, 2, 3]
    assert counted.where("terms <> array_sort(array_distinct(terms)) OR size(terms) <> size(ns)").isEmpty()
    assert rows(ix.row_entries(counted, "id")) == rows(ix.term_counts(docs, "id", stemmed=False))


def test_votes_move_as_lists_and_lie_by_person(spark, tmp_path):
    """No struct for each vote is moved; a task's rows of a person lie together, and votes without a name stay."""
    docs = [(k, "ann bob cy\nx\ny\nbob ann" if k % 2 else "ann  bob\nz", f"s{k}", k) for k in range(20)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    votes = meetings.star(spark, str(tmp_path))["vote"]
    moved = [line for line in votes._jdf.queryExecution().optimizedPlan().toString().split("\n") if "RepartitionByExpression" in line]
    assert moved and "VoteValueName" not in moved[0]
    tasks = votes.select("person_id", F.spark_partition_id().alias("task")).collect()
    runs = [r for k, r in enumerate(tasks) if k == 0 or r != tasks[k - 1]]
    assert len(runs) == len(set(runs)) < len(tasks)
    assert votes.count() == 10 * (3 + 2) + 10 * 3


def test_derived_upsert_joins_as_a_join_does(spark):
    """Null keys match nothing, and keys that repeat on a side stand for each pair."""
    ddl = "k string, d int, value double, updated int"
    stored = spark.createDataFrame([("a", 1, 1.0, 1), ("a", 1, 2.0, 1), ("b", 1, 3.0, 1), (None, 1, 4.0, 1), ("c", None, 5.0, 1)], ddl)
    new = spark.createDataFrame([("a", 1, 6.0, 2), ("a", 1, 7.0, 2), ("z", 9, 8.0, 2), (None, 1, 9.0, 2), ("c", None, 5.5, 2)], ddl)
    entry = st.surrogate_key("t", "k", "d")
    sent = ix.upsert(stored.withColumn("id", entry), new.withColumn("id", entry), ["k", "d"], "id")
    assert rows(ix.upsert(stored, new, ["k", "d"], "id", derived=entry)) == rows(sent)
