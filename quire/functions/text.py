"""Text functions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Function words, and what is stripped from a token's ends.
FUNCTION_WORDS = ("the", "of", "to", "in", "with", "for", "at", "on", "and", "but", "or", "is", "was", "are", "he", "she", "it", "that", "this", "which", "be", "as", "by", "from", "an", "a", "have", "has", "had", "not", "no", "if", "so", "its", "their")
TOKEN_EDGES = " ,.;:!?()[]{}\"'\u201c\u201d\u2018\u2019"
#: White space as Python sees it: Java's Unicode class and four separators.
SPACE = r"(?U)[\s\x1c-\x1f]+"
QUOTE_OPENERS = "\\s(\\[{<\u2014\u2013\u2018\u201c"


def normalize_ws(text: Column) -> Column:
    """No-break spaces become spaces, runs of white space one space, ends are trimmed."""
    return F.trim(F.regexp_replace(F.translate(text, "\u00a0\u2007\u202f", "   "), SPACE, " "))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, SPACE), "")).cast("long")


def stripped_token(token: Column) -> Column:
    return F.btrim(token, F.lit(TOKEN_EDGES))


def is_ascii_word(token: Column) -> Column:
    return token.rlike(r"^[A-Za-z]+(?:[-'][A-Za-z]+)*$")


def function_word_prefix(lower_token: Column) -> Column:
    """The longest function word that the token starts with and a letter follows, else null."""
    words = "|".join(sorted(FUNCTION_WORDS, key=lambda w: (-len(w), w)))
    return F.nullif(F.regexp_extract(lower_token, rf"^({words})(?=\p{{L}})", 1), F.lit(""))


def sanitize_key(value: Column) -> Column:
    return F.translate(F.trim(value), "/ ", "__")


def versioned_key(submission: Column, sku: Column, schema: str, worker: str, rules: str) -> Column:
    return F.concat(F.lit("services/"), submission, F.lit("/"), sku, F.lit(f"/manuscript/v{schema}/w{worker}-r{rules}/manuscript.json"))


def legacy_key(service: Column) -> Column:
    return F.concat(F.lit("services/"), service, F.lit("/manuscript.v1.json"))


def content_hash(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def curly_quotes(text: Column) -> Column:
    """Straight quotes become opening ones at the start and after white space, brackets, dashes and opening quotes, else closing ones."""
    opened = F.regexp_replace(F.regexp_replace(text, f'(?<![^{QUOTE_OPENERS}])"', "\ue000"), f"(?<![^{QUOTE_OPENERS}])'", "\ue001")
    return F.translate(opened, "\"'\ue000\ue001", "\u201d\u2019\u201c\u2018")


def without_zero_width(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, "\u200b\u200c\u200d\ufeff", ""), "\u00a0{2,}", " ")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, " {2,}", " ")
