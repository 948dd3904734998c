"""Column expressions for text: cleaning, tokens, counts, sentences, JSON documents.

Everything here is a built-in JVM expression. Character classes name ``\\p{Z}`` and the
separator controls explicitly, because ``\\s`` of Java leaves out the no-break space.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexigrove.functions.constants import JSON_TEXT_FIELDS, TOKEN_STOP_WORDS

SPACE = r"\s\x0b\p{Z}\x1c-\x1f\x85"
WORD_CHAR = r"\p{L}\p{N}_"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.regexp_replace(F.regexp_replace(_col(c), f"^[{SPACE}]+", ""), f"[{SPACE}]+$", "")


def is_blank(c: str | Column) -> Column:
    """True for null, empty or white space only."""
    return F.coalesce(~_col(c).rlike(f"[^{SPACE}]"), F.lit(True))


def clean_text(c: str | Column) -> Column:
    """Lower case, letters a-z and single spaces only."""
    letters = F.regexp_replace(F.lower(_col(c)), f"[^a-z{SPACE}]+", "")
    return F.trim(F.regexp_replace(letters, f"[{SPACE}]+", " "))


def char_count(c: str | Column) -> Column:
    return F.length(_col(c))


def word_count(c: str | Column) -> Column:
    """Number of runs of characters that are not white space."""
    return F.regexp_count(_col(c), F.lit(f"[^{SPACE}]+"))


def without_stop_words(tokens: Column, stop_words=TOKEN_STOP_WORDS, min_length: int = 3) -> Column:
    stops = list(stop_words)
    return F.filter(tokens, lambda t: (F.length(t) >= min_length) & ~t.isin(stops))


def tokenize(c: str | Column, stop_words=TOKEN_STOP_WORDS, min_length: int = 3) -> Column:
    """Words made wholly of a-z, at least ``min_length`` long, without stop words.

    Any letter, digit or underscore counts as part of a word, so ``café`` and ``abc123`` give nothing. Other words are
    matched whole, with an empty group that goes with the stop words: so a match is only tried where a word begins.
    """
    pattern = f"([a-z]{{{min_length},}}+)(?![{WORD_CHAR}])|[{WORD_CHAR}]++"
    words = F.regexp_extract_all(F.lower(_col(c)), F.lit(pattern), F.lit(1))
    return F.filter(words, lambda t: ~t.isin(["", *stop_words]))


def tokenize_clean(c: str | Column, stop_words=TOKEN_STOP_WORDS, min_length: int = 3) -> Column:
    """``tokenize`` for the output of ``clean_text``, which a split on spaces takes apart."""
    return without_stop_words(F.split(_col(c), " "), stop_words, min_length)


def sentences(c: str | Column) -> Column:
    """Pieces between runs of ``.``, ``!`` and ``?``, stripped."""
    return F.transform(F.split(_col(c), "[.!?]+"), strip)


def contains_any(c: str | Column, terms: Column) -> Column:
    """True where the lower-cased text has any of the terms as a substring."""
    low = F.lower(_col(c))
    return F.exists(terms, lambda t: F.contains(low, t))


def decode_bytes(content: str | Column) -> Column:
    """Text of raw bytes, stripped: as a byte-order mark says, else UTF-8 where valid, else Latin-1. The mark goes."""
    content = _col(content)
    as_utf8 = content.cast("string")
    head = F.hex(F.substring(content, 1, 4))
    text = (
        F.when(head.startswith("EFBBBF"), F.substring(as_utf8, 2, 2**31 - 1))
        .when(head.startswith("FFFE0000"), F.decode(content, "UTF-32"))
        .when(head == "0000FEFF", F.decode(content, "UTF-32"))
        .when(head.startswith("FFFE") | head.startswith("FEFF"), F.decode(content, "UTF-16"))
        .when(F.is_valid_utf8(as_utf8), as_utf8)
        .otherwise(F.decode(content, "ISO-8859-1"))
    )
    return strip(text)


def json_object(c: str | Column) -> Column:
    """A JSON text as ``map<string, variant>``; null unless it is a JSON object."""
    return F.try_parse_json(_col(c)).try_cast("map<string,variant>")


def json_scalar_text(v: Column) -> Column:
    """A JSON value as text: strings bare, ``True`` / ``False`` / ``None``, else JSON."""
    kind = F.schema_of_variant(v)
    return (
        F.when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(v.cast("string")))
        .when(kind == "STRING", v.cast("string"))
        .otherwise(F.to_json(v))
    )


def json_document_text(obj: Column) -> Column:
    """Text of a JSON document: the first text field present, else the empty string."""
    text = F.lit("")
    for name in reversed(JSON_TEXT_FIELDS):
        text = F.when(F.map_contains_key(obj, name), json_scalar_text(F.try_element_at(obj, F.lit(name)))).otherwise(text)
    return F.when(obj.isNotNull(), text)


def json_document_metadata(obj: Column) -> Column:
    """Every other key of a JSON document, each value as JSON text."""
    rest = F.map_filter(obj, lambda k, v: ~k.isin(JSON_TEXT_FIELDS))
    return F.transform_values(rest, lambda k, v: F.to_json(v))
