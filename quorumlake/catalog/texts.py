"""Text, value and URI functions, and what is read out of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import values as va
from ..operators.index import term_rows, vocabulary_stems
from ..operators.match import agenda_scores
from ..operators.select import not_status
from ..sources.pages import ListingLayout, list_item_links, outcome_counts, page_records
from . import score_sql, stem_sql
from .registry import load, load_wide, query

STOP_LIST = ", ".join(f"'{word}'" for word in tx.STOP_WORDS)
STRIPPED = (
    "regexp_replace(translate(lower(text), chr(10) || chr(9), '  '), '[!-/:-@\\[-`{-~]+', '', 'g')"
)
# Documents hold only word characters and spaces once punctuation is gone, so
# removing stop words is filtering tokens.
TERMS = f"list_filter(string_split({STRIPPED}, ' '), lambda x: x <> '' AND x NOT IN ({STOP_LIST}))"


def _documents(name, column, make, sql):
    @query(name, f"SELECT doc_id, {sql} AS {column} FROM documents")
    def run(spark, root):
        return load_wide(spark, root, "documents").select("doc_id", make(F.col("text")).alias(column))

    return run


_documents("text_lower", "lowered", F.lower, "lower(text)")
_documents("text_ws", "spaced", tx.whitespace_to_space, "translate(text, chr(10) || chr(9), '  ')")
_documents("text_strip_punct", "stripped", tx.strip_punctuation, "regexp_replace(text, '[!-/:-@\\[-`{-~]+', '', 'g')")
_documents(
    "text_stopwords", "kept",
    lambda c: tx.remove_stop_words(tx.strip_punctuation(tx.whitespace_to_space(F.lower(c)))),
    f"array_to_string(list_transform(string_split({STRIPPED}, ' '), "
    f"lambda x: CASE WHEN x IN ({STOP_LIST}) THEN '' ELSE x END), ' ')",
)
_documents(
    "text_collapse", "collapsed", tx.collapse_spaces,
    "nullif(trim(regexp_replace(text, ' {2,}', ' ', 'g')), '')",
)
_documents("clean_text", "cleaned", tx.clean_for_index, f"nullif(array_to_string({TERMS}, ' '), '')")
_documents("clean_field", "cleaned", tx.clean_field, "regexp_replace(text, '[\\r\\n_]', '', 'g')")
_documents("truncate_text", "cut", tx.truncate, "CASE WHEN length(text) > 800 THEN text[1:800] || '...' ELSE text END")
_documents(
    "clean_web_string", "cleaned", tx.clean_web_string,
    "regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(text, chr(10), ''), chr(9), ''), "
    "chr(160), ''), '^ ', ''), ' $', ''), '\\.$', '')",
)
_documents(
    "fix_symbol_spacing", "fixed", tx.fix_symbol_spacing,
    "regexp_replace(text, '([#$(<\\[{]) ', ' \\1', 'g')",
)


@query(
    "term_is_eos",
    "SELECT DISTINCT term, regexp_matches(term, '[.!?]') AS is_eos "
    "FROM (SELECT unnest(string_split(text, ' ')) AS term FROM documents)",
)
def term_is_eos(spark, root):
    terms = load_wide(spark, root, "documents").select(F.explode(F.split("text", " ")).alias("term")).distinct()
    return terms.select("term", tx.ends_sentence(F.col("term")).alias("is_eos"))


@query("text_stem", f"""
    WITH terms AS (SELECT DISTINCT unnest({TERMS}) AS term FROM documents), {stem_sql.stems('terms')} SELECT term, stem FROM stems""")
def text_stem(spark, root):
    return vocabulary_stems(term_rows(load_wide(spark, root, "documents"), "doc_id"))


# The page tables carry no meeting markup, so each page's own title, address
# and links are laid out as one entry of a listing page.
def page_title():
    return F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)


_SQL_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
_SUFFIXES = {0: "", 1: " - Special Meeting", 2: " Special Meeting - Public Hearing", 3: " 12/4/2019"}


def _suffixed(title, suffix_of):
    cases = F.lit("")
    for rest, suffix in _SUFFIXES.items():
        cases = F.when(suffix_of % 4 == rest, F.lit(suffix)).otherwise(cases)
    return F.concat(title, cases)


@query("normalize_name", f"SELECT page_id, replace({_SQL_TITLE}, chr(10), '') AS body FROM pages")
def normalize_name(spark, root):
    title = _suffixed(page_title(), F.col("page_id"))
    return load_wide(spark, root, "pages").select("page_id", tx.normalize_name(title).alias("body"))


@query(
    "parse_mdy",
    "SELECT o_orderkey, date_trunc('day', o_orderdate) AS parsed FROM orders",
)
def parse_mdy(spark, root):
    orders = load(spark, root, "orders").select("o_orderkey", F.date_format("o_orderdate", "M/d/yyyy").alias("d"))
    return orders.select("o_orderkey", va.parse_month_day_year(F.col("d")).cast("timestamp_ntz").alias("parsed"))


@query(
    "parse_datetime12",
    "SELECT event_id, date_trunc('minute', ts) AS parsed FROM events",
)
def parse_datetime12(spark, root):
    events = load(spark, root, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T00:00:00'").alias("d"),
        F.date_format("ts", "h:mm a").alias("c"),
    )
    parsed = va.parse_date_and_clock(F.col("d"), F.col("c"))
    return events.select("event_id", parsed.cast("timestamp_ntz").alias("parsed"))


@query(
    "iso_timestamp",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso, ts AS back, "
    "date_trunc('second', ts) AS back_short FROM events",
)
def iso_timestamp(spark, root):
    events = load(spark, root, "events").withColumn("iso", va.to_iso_z(F.col("ts")))
    short = F.regexp_replace("iso", r"\.\d+Z", "Z")
    return events.select(
        "event_id",
        "iso",
        va.from_iso_z(F.col("iso")).cast("timestamp_ntz").alias("back"),
        va.from_iso_z(short).cast("timestamp_ntz").alias("back_short"),
    )


@query(
    "default_index",
    "SELECT l_orderkey, l_linenumber, coalesce(nullif(CAST(floor(l_discount * 20) AS INTEGER), 0), -1) AS idx FROM lineitem",
)
def default_index(spark, root):
    lines = load(spark, root, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", va.index_or_default(F.floor(F.col("l_discount") * 20)).alias("idx"))


@query(
    "split_agenda",
    """SELECT doc_id, i - 1 AS position, regexp_replace(regexp_replace(regexp_replace(
           replace(replace(replace(items[i], chr(10), ''), chr(9), ''), chr(160), ''), '^ ', ''), ' $', ''), '\\.$', '') AS item
       FROM (SELECT doc_id, items, unnest(range(1, len(items) + 1)) AS i FROM (
         SELECT doc_id, CASE WHEN contains(text, ';') THEN string_split(text, ';') ELSE string_split(text, ',') END AS items
         FROM (SELECT doc_id, replace(replace(text, 'Agenda:', ''), 'Agenda Items:', '') AS text FROM documents)))""",
)
def split_agenda(spark, root):
    docs = load_wide(spark, root, "documents")
    agenda = F.concat(F.lit("Agenda:"), F.col("text"))
    exploded = docs.select("doc_id", F.posexplode(tx.split_agenda(agenda)).alias("position", "item"))
    return exploded.withColumn("position", F.col("position").cast("long"))


@query(
    "page_links",
    "SELECT page_id, unnest(regexp_extract_all(html, '<li><a href=\"([^\"]*)\"', 1)) AS href FROM pages",
)
def page_links(spark, root):
    return list_item_links(load_wide(spark, root, "pages"), "page_id").drop("position")


@query(
    "resolve_route",
    """SELECT page_id, href, CASE WHEN regexp_matches(href, 'https?://') THEN href ELSE
         regexp_replace(regexp_replace(url, '/$', ''), '/?[^/]*$', '') || '/' || regexp_replace(href, '^/', '') END AS uri
       FROM (SELECT page_id, url, unnest(list_concat([url], regexp_extract_all(html, '<li><a href="([^"]*)"', 1))) AS href
             FROM pages)""",
)
def resolve_route(spark, root):
    links = F.concat(F.array("url"), F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)"'), 1))
    pages = load_wide(spark, root, "pages").select("page_id", "url", F.explode(links).alias("href"))
    return pages.select("page_id", "href", tx.resolve_route(F.col("url"), F.col("href")).alias("uri"))


def player_script():
    return F.concat(
        F.lit("play('http://video.example.gov:8080/media/"), F.regexp_extract("url", "//([a-z]+)", 1), F.lit(" "),
        F.col("page_id").cast("string"), F.when(F.col("page_id") % 5 == 0, ".avi").otherwise(".mp4"),
        F.lit("', '/captions/"), F.col("page_id").cast("string"),
        F.when(F.col("page_id") % 3 == 0, ".srt').").otherwise(".vtt')."),
    )


_HOST = r"video\.example\.gov[:0-9]*"
_SQL_HOST = "regexp_extract(url, '//([a-z]+)', 1)"


@query(
    "extract_uri",
    "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE "
    "'https://cc.example.gov//captions/' || page_id || '.vtt' END AS caption_uri FROM pages",
)
def extract_uri(spark, root):
    return load_wide(spark, root, "pages").select(
        "page_id", tx.caption_uri(player_script(), "https://cc.example.gov/").alias("caption_uri")
    )


@query(
    "extract_uri_required",
    f"""SELECT page_id, CASE WHEN page_id % 5 = 0 THEN NULL ELSE
          'https://video.example.gov:8080/media/' || {_SQL_HOST} || page_id || '.mp4' END AS video_uri,
        CASE WHEN page_id % 5 = 0 THEN 'unparseable' ELSE 'parsed' END AS status FROM pages""",
)
def extract_uri_required(spark, root):
    video = tx.video_uri(player_script(), _HOST)
    status = F.when(video.isNull(), "unparseable").otherwise("parsed")
    return load_wide(spark, root, "pages").select("page_id", video.alias("video_uri"), status.alias("status"))


def listing_pages(spark, root, day=None):
    """Each page as a listing page with one entry made of its own data."""
    pages = load_wide(spark, root, "pages")
    if day is None:
        day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 28).cast("int"))
    words = F.regexp_extract_all("html", F.lit('<li><a href="/([^"]*)"'), 1)
    entry = F.concat(
        F.lit('<html><body><div class="row borderBottomNone paginationItem"><div class="col-xs-12 col-sm-4 col-md-3">'),
        F.lit('<a href="/watch?id='), F.col("page_id").cast("string"), F.lit('" onclick="'), player_script(),
        F.lit('"><img src="x.jpg"></a></div><div class="col-xs-12 col-sm-8 col-md-9"><h2><a>'),
        _suffixed(page_title(), F.col("page_id")), F.lit('</a></h2><div class="videoDate">'),
        F.date_format(day, "M/d/yyyy"), F.lit('</div><div class="titleExcerptText"><p>Agenda: '),
        F.array_join(words, "; "), F.lit("</p></div></div></div></body></html>"),
    )
    return pages.select("page_id", "url", F.col("page_id").cast("string").alias("entry_id"), entry.alias("html"))


def listing_records(spark, root):
    now = F.lit("2024-01-20 12:00:00").cast("timestamp")
    return page_records(
        listing_pages(spark, root), now, ListingLayout(), _HOST, "https://cc.example.gov/"
    )


# Ampersand entities are the only ones in page titles.
_ENTRY_SQL = f"""
    SELECT page_id, url, day, CASE WHEN page_id % 5 = 0 THEN 'unparseable'
           WHEN day > TIMESTAMP '2024-01-12 12:00:00' AND day < TIMESTAMP '2024-01-20 12:00:00' THEN 'parsed'
           ELSE 'out-of-bounds' END AS status,
      regexp_replace(regexp_replace(regexp_replace(
        replace({_SQL_TITLE}, '&amp;', '&'), '^ ', ''), ' $', ''), '\\.$', '') AS body
    FROM (SELECT *, TIMESTAMP '2024-01-01' + to_days(CAST(page_id % 28 AS INTEGER)) AS day FROM pages)"""


@query(
    "page_records",
    f"""SELECT page_id, status, body, day AS event_datetime,
          regexp_replace(regexp_replace(url, '/$', ''), '/?[^/]*$', '') || '/watch?id=' || page_id AS source_uri
        FROM ({_ENTRY_SQL})""",
)
def page_records_query(spark, root):
    records = listing_records(spark, root)
    page = F.regexp_extract("source_uri", r"id=(\d+)\z", 1).cast("long").alias("page_id")
    return records.select(
        page, "status", "body", F.col("event_datetime").cast("timestamp_ntz").alias("event_datetime"), "source_uri"
    )


@query(
    "outcome_counts",
    """SELECT event_type, count(*) FILTER (WHERE value > 2) AS success,
         count(*) FILTER (WHERE value <= 2 AND value > 1) AS warning,
         count(*) FILTER (WHERE value <= 1) AS error FROM events GROUP BY event_type""",
)
def outcome_counts_query(spark, root):
    status = F.when(F.col("value") > 2, "parsed").when(F.col("value") > 1, "out-of-bounds").otherwise("unparseable")
    return outcome_counts(load(spark, root, "events").select("event_type", status.alias("status")), "event_type")


@query("sha256_key", "SELECT page_id, sha256(url) AS key FROM pages")
def sha256_key(spark, root):
    return load_wide(spark, root, "pages").select("page_id", tx.sha256_key(F.col("url")).alias("key"))


@query(
    "content_path",
    "SELECT page_id, regexp_replace(sha256(url), '(..)', '\\1/', 'g') || page_id || '.html' AS path FROM pages",
)
def content_path(spark, root):
    name = F.concat(F.col("page_id").cast("string"), F.lit(".html"))
    return load_wide(spark, root, "pages").select("page_id", tx.content_path(tx.sha256_key(F.col("url")), name).alias("path"))


@query(
    "uri_parts",
    """SELECT page_id, regexp_extract(url, '[^/]*$') AS filename,
         regexp_extract(regexp_extract(url, '[^/]*$'), '\\.([^.]*)$', 1) AS suffix FROM pages""",
)
def uri_parts(spark, root):
    url = F.col("url")
    return load_wide(spark, root, "pages").select(
        "page_id", tx.uri_filename(url).alias("filename"), tx.uri_suffix(url).alias("suffix")
    )


@query(
    "content_type",
    """SELECT l_orderkey, l_linenumber, CASE suffix WHEN 'wav' THEN 'audio/wav' WHEN 'txt' THEN 'text/plain'
         WHEN 'err' THEN 'text/plain' WHEN 'out' THEN 'text/plain' WHEN 'mp4' THEN 'video/mp4' END AS content_type
       FROM (SELECT *, ['wav', 'txt', 'err', 'out', 'mp4', 'pdf'][1 + l_partkey % 6] AS suffix FROM lineitem)""",
)
def content_type(spark, root):
    suffixes = F.array(*[F.lit(s) for s in ("wav", "txt", "err", "out", "mp4", "pdf")])
    suffix = F.get(suffixes, (F.col("l_partkey") % 6).cast("int"))
    return load(spark, root, "lineitem").select("l_orderkey", "l_linenumber", tx.content_type(suffix).alias("content_type"))


@query("token_set_score", f"""
    WITH pairs AS (SELECT t.conv_id, t.turn, t.text AS a, n.text AS b FROM conversations AS t JOIN conversations AS n
      ON n.conv_id = t.conv_id AND n.turn = t.turn + 1), {score_sql.token_sets('pairs')}
    SELECT conv_id, turn, round(token_set, 6) AS score FROM pairs JOIN token_sets USING (a, b)""")
def token_set_score(spark, root):
    turns = load(spark, root, "conversations")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next_text"))
    scored = agenda_scores(turns.join(following, ["conv_id", "turn"]), "text", "next_text")
    return scored.select("conv_id", "turn", F.round("score", 6).alias("score"))


@query(
    "status_of_records",
    f"SELECT status, count(*) AS n FROM ({_ENTRY_SQL}) WHERE status <> 'unparseable' GROUP BY status",
)
def status_of_records(spark, root):
    kept = listing_records(spark, root).where(not_status(F.col("status"), "unparseable"))
    return kept.groupBy("status").agg(F.count("*").alias("n"))
