"""Text column functions: the index cleaner, field cleaners and URI helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English stop words that can still occur once punctuation is gone.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom this "
    "that these those am is are was were be been being have has had having do does did doing a an "
    "the and but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not "
    "only own same so than too very s t can will just don should now d ll m o re ve y ain aren "
    "couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn"
).split()

# The 32 ASCII punctuation characters, as a run of a character class.
ASCII_PUNCTUATION = r"[!-/:-@\[-`{-~]+"

# Content type by file suffix.
SUFFIX_CONTENT_TYPES = {
    "wav": "audio/wav",
    "txt": "text/plain",
    "err": "text/plain",
    "out": "text/plain",
    "mp4": "video/mp4",
}

# Item names longer than this are cut and marked with an ellipsis.
MAX_NAME_LENGTH = 800


def whitespace_to_space(text: Column) -> Column:
    return F.translate(text, "\n\t", "  ")


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, ASCII_PUNCTUATION, "")


def index_term(token: Column) -> Column:
    """A space-free token without stop words; null where it is one.

    Most tokens are plain words and need one set lookup. Only those holding
    other characters are searched for stop words at Unicode word boundaries.
    """
    pattern = rf"(?U)\b(?:{'|'.join(STOP_WORDS)})\b"
    mixed = F.when(token.rlike(r"(?U)\W"), F.regexp_replace(token, pattern, "")).otherwise(token)
    return F.when(~token.isin(STOP_WORDS), mixed)


def remove_stop_words(text: Column) -> Column:
    """Drop stop words, leaving the gaps."""
    kept = F.transform(F.split(text, " "), lambda token: F.coalesce(index_term(token), F.lit("")))
    return F.array_join(kept, " ")


def collapse_spaces(text: Column) -> Column:
    """Single spaces, trimmed; text with nothing left becomes null."""
    return F.nullif(F.trim(F.regexp_replace(text, " {2,}", " ")), F.lit(""))


def index_tokens(text: Column) -> Column:
    """Lower-case tokens without punctuation, empty ones included."""
    return F.split(strip_punctuation(whitespace_to_space(F.lower(text))), " ")


def clean_for_index(text: Column) -> Column:
    """Lower case, no punctuation, no stop words, single spaces (unstemmed)."""
    kept = F.filter(F.transform(index_tokens(text), index_term), lambda term: term != "")
    return F.nullif(F.array_join(kept, " "), F.lit(""))


def ends_sentence(term: Column) -> Column:
    """A term holding `.`, `!` or `?` anywhere closes a sentence."""
    return term.rlike("[.!?]")


def clean_field(text: Column) -> Column:
    """Meeting-document strings without carriage returns, newlines or underscores."""
    return F.regexp_replace(text, r"[\r\n_]", "")


def clean_web_string(text: Column) -> Column:
    """Scraped strings: no breaks or hard spaces, then at most one leading
    space, one trailing space and one trailing dot removed, in that order."""
    bare = F.regexp_replace(text, "[\n\t\u00a0]", "")
    no_lead = F.regexp_replace(bare, "^ ", "")
    no_trail = F.regexp_replace(no_lead, r" \z", "")
    return F.regexp_replace(no_trail, r"\.\z", "")


def truncate(text: Column, limit: int = MAX_NAME_LENGTH) -> Column:
    shortened = F.concat(F.substring(text, 1, limit), F.lit("..."))
    return F.when(F.length(text) > limit, shortened).otherwise(text)


def normalize_name(text: Column) -> Column:
    """A meeting title reduced to the body name."""
    name = F.regexp_replace(text, "\n", "")
    name = F.replace(name, F.lit(" - Special Meeting"), F.lit(""))
    name = F.replace(name, F.lit(" Special Meeting - Public Hearing"), F.lit(""))
    return F.regexp_replace(name, r" [0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}\z", "")


def split_agenda(text: Column) -> Column:
    """Agenda text to cleaned items: on `;` where there is one, else on `,`."""
    bare = F.replace(F.replace(text, F.lit("Agenda:"), F.lit("")), F.lit("Agenda Items:"), F.lit(""))
    pieces = F.when(F.contains(bare, F.lit(";")), F.split(bare, ";", -1)).otherwise(F.split(bare, ",", -1))
    return F.transform(pieces, clean_web_string)


def fix_symbol_spacing(text: Column) -> Column:
    """`roughly$ 19` to `roughly $19`, for opening symbols."""
    return F.regexp_replace(text, r"([#$(<\[{]) ", " $1")


def resolve_route(sibling: Column, route: Column) -> Column:
    """A relative route placed beside `sibling`; absolute routes are kept."""
    parent = F.regexp_replace(F.regexp_replace(sibling, r"/\z", ""), r"/?[^/]*\z", "")
    relative = F.concat(parent, F.lit("/"), F.regexp_replace(route, "^/", ""))
    return F.when(route.rlike("https?://"), route).otherwise(relative)


def caption_uri(script: Column, base: str) -> Column:
    """The first `.vtt` path in a script, below `base`; null where there is none."""
    path = F.nullif(F.regexp_extract(script, r"[a-zA-Z0-9/_]+\.vtt", 0), F.lit(""))
    return F.concat(F.lit(base), path)


def video_uri(script: Column, host_pattern: str) -> Column:
    """The first video file on `host_pattern` in a script, spaces removed."""
    found = F.regexp_extract(script, host_pattern + r"[a-zA-Z0-9/_ ]*\.(?:mp4|flv)", 0)
    return F.concat(F.lit("https://"), F.replace(F.nullif(found, F.lit("")), F.lit(" "), F.lit("")))


def is_local_uri(uri: Column) -> Column:
    return ~uri.rlike("^(https?|gc|s3)://")


def uri_filename(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def uri_suffix(uri: Column) -> Column:
    """The part after the last dot of the file name, or an empty string."""
    return F.regexp_extract(uri_filename(uri), r"\.([^.]*)\z", 1)


def content_type(suffix: Column) -> Column:
    """Content type of a suffix; null where the suffix is not known."""
    entries = [F.lit(part) for pair in SUFFIX_CONTENT_TYPES.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), suffix)


def sha256_key(text: Column) -> Column:
    return F.sha2(text, 256)


def content_path(digest: Column, name: Column) -> Column:
    """A digest cut in two-character folders, ending in the file name."""
    return F.concat(F.regexp_replace(digest, "(..)", "$1/"), name)
