"""Spelling variants by a relational trie frontier.

The words, each with an end mark, form a trie that is held as a distributed
table of edges: the prefix an edge leads to, how many words lie beneath, one of
them, and a mask of the letters that follow. The frontier is a table of states
(word, node, rest of the word, edits), all at the same depth. A level joins it
with the edges of the next depth: a letter of the word that matches keeps the
edits, and a state without an edit may also skip one letter or take another
edge than its letter. A state whose next letter the mask rules out goes no
further. An edge with one word beneath is the end of the path: what is left of
both words must agree, and if one edit was spent, they are neighbours.

Every word walks twice, as it stands and in reverse, and may spend its edit only
in the second half of its way: an edit in the first half of the word is in the
second of the reverse. So the walk starts at the node of the half, no state
branches near the root, where nodes have the most edges and hold the most
words, and edges above the half of their words are left out. The first letter
of a node, `>` or `<`, tells the two tries apart, which share table and levels.

A pair is found from the longer word by skipping a letter, the last of a run of
equal ones, or from the word with the smaller letter by replacing it.

Words over LONG letters would need as many levels as they have letters. They
meet by equal halves instead, one of which any single edit leaves as it is, and
their edit distance is taken; the same pairs, on a shorter way.

Defined cases: a null text has no words, a null doc_id counts as the word
"null"; repeated rows count as often as they stand; equal counts go to the
smaller word in code point order; extra columns play no part; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_path, written

LETTER = "[A-Za-z\\u00C0-\\u00FF]"
LEAST_LETTERS = 5
LEAST_COUNT = 3
TYPO_EVERY = 97
RATIO = 2

#: smaller than every letter
END = "$"
FORTH, BACK = ">", "<"
LONG = 64


def word_counts(
    docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, typo_every: int | None = None
) -> DataFrame:
    """(word, n) of the runs of letters, A-Z in lower case.

    With `typo_every`, about one in so many pairs of document and word loses a
    letter, which a hash of both chooses: a reproducible source of misspellings.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("doc"),
        F.explode(F.regexp_extract_all("text", F.lit(f"{LETTER}{{{least_letters},}}"), F.lit(0))).alias("run"),
    )
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ascii_only = F.octet_length("run") == F.length("run")
    lowered = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", capitals, capitals.lower()))
    words = runs.select("doc", lowered.alias("word"))
    if typo_every:
        hashed = words.select("word", F.crc32(F.concat("doc", F.lit(":"), "word")).alias("h"))
        at = F.pmod("h", F.length("word")).cast("int")
        shorter = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))
        words = hashed.select(F.when(F.col("h") % typo_every == 0, shorter).otherwise(F.col("word")).alias("word"))
        words = words.where(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _bit(letter: Column) -> Column:
    """A letter's bit in a mask; letters that share one only weaken the mask."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(letter), F.lit(64)))


def paths(words: DataFrame) -> DataFrame:
    """(path, start): every word in both directions, marked, with the depth at which it may begin to spend its edit."""
    half = F.floor(F.length("word") / 2).cast("int")
    forth = words.select(F.concat(F.lit(FORTH), "word", F.lit(END)).alias("path"), (half + 1).alias("start"))
    back = words.select(
        F.concat(F.lit(BACK), F.reverse("word"), F.lit(END)).alias("path"), (F.length("word") - half + 1).alias("start")
    )
    return forth.unionByName(back)


def edge_table(ways: DataFrame) -> DataFrame:
    """(depth, child, size, sole, follow): every prefix of the paths beyond their start as the edge that leads to it."""
    steps = ways.select("path", F.explode(F.sequence(F.col("start") + 1, F.length("path"))).alias("depth"))
    prefixes = steps.select(
        "depth", "path", F.col("path").substr(F.lit(1), F.col("depth")).alias("child"),
        F.col("path").substr(F.col("depth") + 1, F.lit(1)).alias("letter"),
    )
    return prefixes.groupBy("depth", "child").agg(
        F.count("*").alias("size"), F.min("path").alias("sole"), F.bit_or(_bit(F.col("letter"))).alias("follow")
    )


def _first(text: str, skip: int = 0) -> Column:
    return F.substring(text, 1 + skip, 1)


def _level(states: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """The states one level deeper, and the neighbours found on the way (with `near`)."""
    rest_from = lambda skip: F.col("rest").substr(F.lit(1 + skip), F.length("rest"))
    fresh = states.where("edits = 0")
    along = states.select("path", F.concat("node", _first("rest")).alias("child"), rest_from(1).alias("rest"), "edits")
    skipped = fresh.where(F.length("rest") > 1).where(_first("rest") != _first("rest", 1)).select(
        "path", F.concat("node", _first("rest", 1)).alias("child"), rest_from(2).alias("rest"), F.lit(1).alias("edits")
    )
    met = along.unionByName(skipped).join(edges, "child")
    branches = edges.withColumns({"node": F.col("child").substr(F.lit(1), F.lit(depth)), "letter": F.col("child").substr(F.lit(depth + 1), F.lit(1))})
    replaced = (
        fresh.where(F.length("rest") > 1).join(branches, "node").where(F.col("letter") > _first("rest"))
        .select("path", "child", rest_from(1).alias("rest"), F.lit(1).alias("edits"), "size", "sole", "follow")
    )
    arrived = met.unionByName(replaced)
    alone = F.col("size") == 1
    left = F.col("sole").substr(F.lit(depth + 2), F.length("sole"))
    found = alone & (F.col("edits") == 1) & (F.col("rest") == left)
    onward = ~alone & ((F.col("edits") == 0) | (F.col("follow").bitwiseAND(_bit(_first("rest"))) != 0))
    return arrived.where(found | onward).select(
        "path", F.col("child").alias("node"), "rest", "edits", F.when(alone, F.col("sole")).alias("near")
    )


def _long_pairs(words: DataFrame) -> DataFrame:
    """Pairs of words one edit apart of which one has more than LONG letters."""
    long = words.where(F.length("word") >= LONG).select("word", F.length("word").alias("size"))

    def halves(size: Column) -> Column:
        half = F.floor(size / 2).cast("int")
        head, tail = F.col("word").substr(F.lit(1), half), F.col("word").substr(F.length("word") - size + half + 1, size - half)
        return F.explode(F.array(F.xxhash64(F.lit("head"), size, head), F.xxhash64(F.lit("tail"), size, tail)))

    targets = long.select(F.col("word").alias("near"), halves(F.col("size")).alias("half"))
    probes = [long.select("word", halves(F.col("size") - shorter).alias("half")) for shorter in (0, 1)]
    met = probes[0].unionByName(probes[1]).join(targets, "half").where("word <> near")
    once = (F.length("word") > F.length("near")) | (F.col("word") < F.col("near"))
    longer = F.greatest(F.length("word"), F.length("near")) > LONG
    return met.where(once & longer & (F.levenshtein("word", "near", 1) == 1)).select("word", "near").distinct()


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near): every pair of distinct words that one inserted, deleted or replaced letter parts, once.

    `words` is a stored table of distinct words.
    """
    spark = words.sparkSession
    short = words.select("word").where(F.length("word") <= LONG)
    longest = short.agg(F.max(F.length("word"))).first()[0] or 0
    ways_path, trie_path = work_path(spark, "paths"), work_path(spark, "trie")
    paths(short).write.partitionBy("start").parquet(ways_path)
    ways = spark.read.schema("path string, start int").parquet(ways_path)
    edge_table(ways).write.partitionBy("depth").parquet(trie_path)
    trie = spark.read.schema("depth int, child string, size long, sole string, follow long").parquet(trie_path)
    pairs = _long_pairs(words)
    states = None
    last_start = longest - longest // 2 + 1
    for depth in range(1, longest + 2):
        starting = ways.where(F.col("start") == depth).select(
            "path", F.col("path").substr(F.lit(1), F.lit(depth)).alias("node"),
            F.col("path").substr(F.lit(depth + 1), F.length("path")).alias("rest"), F.lit(0).alias("edits"),
        )
        if states is not None:
            starting = states.unionByName(starting)
        elif starting.isEmpty():
            continue
        reached = written(_level(starting, trie.where(F.col("depth") == depth + 1).drop("depth"), depth), "frontier")
        pairs = pairs.unionByName(reached.where("near IS NOT NULL").select(_word("path").alias("word"), _word("near").alias("near")))
        states = reached.where("near IS NULL").drop("near")
        if depth >= last_start and states.isEmpty():
            break
    return pairs.distinct()


def _word(path: str) -> Column:
    """The word of a path."""
    bare = F.col(path).substr(F.lit(2), F.length(path) - 2)
    return F.when(_first(path) == BACK, F.reverse(bare)).otherwise(bare)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): each word's forms followed to the last. Counts at least double, so no path is a circle."""
    roots = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("far"))
        followed = written(roots.join(onward, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.isnotnull("far").alias("moved")), "roots")
        roots = followed.select("word", "root")
        if followed.where("moved").isEmpty():
            return roots


def grouped(words: DataFrame, ratio: float = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n) rows with distinct words.

    A word's form is its near word of largest n, ties to the smaller word, if
    that is at least `ratio` times the word's own; the root is the last form.
    """
    words = written(words.select("word", "n"), "words")
    pairs = written(near_pairs(words), "pairs")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    joined = words.join(best, "word", "left")
    kept = -F.col("best.less") >= ratio * F.col("n")
    formed = written(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(kept, F.col("best.near")).alias("form"), F.when(kept, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: words one letter apart share what is left when one letter of each is taken out, or one word is what is left of the other
SQL = f"""
WITH RECURSIVE steps AS (
  SELECT LIST_TRANSFORM(RANGE(256), LAMBDA x: LIST_REDUCE(LIST_PREPEND(x, RANGE(8)),
           LAMBDA c, k: CASE WHEN c % 2 = 1 THEN XOR(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
runs AS (
  SELECT COALESCE(doc_id::VARCHAR, 'null') AS doc,
         TRANSLATE(UNNEST(REGEXP_EXTRACT_ALL(text, '[A-Za-zÀ-ÿ]+')), '{_CAPITALS}', '{_CAPITALS.lower()}') AS run
  FROM documents),
told AS (SELECT doc, run, COUNT(*) AS times FROM runs WHERE LENGTH(run) >= {LEAST_LETTERS} GROUP BY ALL),
bytes AS (SELECT run, times, HEX(ENCODE(doc || ':' || run)) AS code FROM told),
hashed AS (
  SELECT run, times, XOR(4294967295, LIST_REDUCE(
           LIST_PREPEND(4294967295, LIST_TRANSFORM(RANGE(LENGTH(code) // 2), LAMBDA i: ('0x' || SUBSTR(code, 2 * i + 1, 2))::BIGINT)),
           LAMBDA c, b: XOR(c >> 8, crc[1 + (XOR(c, b) & 255)]))) AS h
  FROM bytes, steps),
typed AS (
  SELECT CASE WHEN h % {TYPO_EVERY} = 0 THEN run[1:h % LENGTH(run)] || run[h % LENGTH(run) + 2:] ELSE run END AS word, times FROM hashed),
words AS (
  SELECT word, SUM(times)::BIGINT AS n FROM typed WHERE LENGTH(word) >= {LEAST_LETTERS} GROUP BY word HAVING SUM(times) >= {LEAST_COUNT}),
cuts AS (
  SELECT word, n, k, word[1:k] || '-' || word[k + 2:] AS gap, word[1:k] || word[k + 2:] AS less
  FROM (SELECT word, n, UNNEST(RANGE(LENGTH(word))) AS k FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b ON a.gap = b.gap AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.less = b.word),
best AS (
  SELECT word, COUNT(*) AS n_near, ARG_MIN(near, (-n, near)) AS near, MAX(n) AS near_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, COALESCE(b.n_near, 0) AS n_near,
         CASE WHEN b.near_n >= {RATIO} * w.n THEN b.near END AS form, CASE WHEN b.near_n >= {RATIO} * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
followed AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT f.word, g.form FROM followed f JOIN formed g ON f.root = g.word WHERE g.form IS NOT NULL),
roots AS (SELECT f.word, f.root FROM followed f JOIN formed g ON f.root = g.word WHERE g.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""
