"""Ordinals: Arabic, Roman and spelled numbers as columns; null where a token is none."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Number words and Roman digits.
UNITS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
TEENS = ("ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
TENS = ("twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


def spelled() -> dict[str, int]:
    """The words for 1 to 99, compounds with a space."""
    out = {w: k for k, w in enumerate((*UNITS, *TEENS), 1)}
    for k, ten in enumerate(TENS, 2):
        out |= {ten: 10 * k} | {f"{ten} {unit}": 10 * k + n for n, unit in enumerate(UNITS, 1)}
    return out


def _positive(value: Column) -> Column:
    return F.when(value > 0, value)


def parse_arabic(token: Column) -> Column:
    token = F.trim(token)
    return _positive(F.when(token.rlike("^[0-9]+$"), token.try_cast("int")))


def parse_roman(token: Column) -> Column:
    """A digit before a larger one counts against the total; other orders add up, so IIII is 4."""
    token = F.upper(F.trim(token))
    value = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in ROMAN.items()))
    digits = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.element_at(value, c))
    step = lambda acc, v: F.struct((acc["total"] + v - F.when(acc["last"] < v, 2 * acc["last"]).otherwise(0)).alias("total"), v.alias("last"))
    total = F.aggregate(digits, F.struct(F.lit(0).alias("total"), F.lit(1 << 20).alias("last")), step, lambda acc: acc["total"])
    return _positive(F.when(token.rlike("^[IVXLCDM]+$"), total))


def parse_word(token: Column) -> Column:
    """The words are one folded constant, so that plans which name this often stay small."""
    words = F.str_to_map(F.lit(",".join(f"{k}:{v}" for k, v in spelled().items())), F.lit(","), F.lit(":"))
    return F.try_element_at(words, F.trim(F.regexp_replace(F.lower(F.trim(token)), r"[\s\-]+", " "))).cast("int")


def parse_ordinal(token: Column) -> Column:
    return F.coalesce(parse_arabic(token), parse_roman(token), parse_word(token))


def ordinal_style(token: Column) -> Column:
    return F.when(parse_arabic(token).isNotNull(), "arabic").when(parse_roman(token).isNotNull(), "roman").when(parse_word(token).isNotNull(), "words")
