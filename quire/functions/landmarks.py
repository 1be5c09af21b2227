"""Landmarks: chapter, part and unnumbered headings, recognised in whole texts and line by line."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.ordinals import parse_arabic, parse_roman, parse_word
from quire.functions.text import normalize_ws

#: Section words by class, and what may follow an ordinal.
CHAPTER_WORDS = ("chapter", "chap.", "stave", "letter", "canto", "section", "act", "scene", "lesson")
PART_WORDS = ("part", "book", "volume", "vol.")
UNNUMBERED = ("prologue", "epilogue")
ENDS = ".:\u2014"
_words = "|".join(re.escape(w) for w in sorted(CHAPTER_WORDS + PART_WORDS, key=lambda w: (-len(w), w)))
NUMBERED = rf"^({_words})\s+(\S+?)([{ENDS}])?(?:\s+(.+))?$"
FUSED = rf"^({_words})([A-Za-z0-9\-]+)[{ENDS}]?$"
BARE = rf"^({'|'.join(UNNUMBERED)})(?:[{ENDS}])?(?:\s+(.+))?$"
LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
FIELDS = "struct<kind:string,word:string,ordinal:int,display:string,style:string,title:string,subtype:string,fused:boolean>"


def _group(text: Column, pattern: str, k: int) -> Column:
    return F.nullif(F.regexp_extract(text, f"(?iu){pattern}", k), F.lit(""))


def _kind(word: Column) -> Column:
    return F.when(F.rtrim(F.lower(word), F.lit(".")).isin([w.rstrip(".") for w in PART_WORDS]), "part").otherwise("chapter")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _counted(word: Column, token: Column, title: Column, fused: bool) -> Column:
    none = F.lit(None).cast("string")

    def with_token(g: Column) -> Column:
        values = F.struct(parse_arabic(g["token"]).alias("arabic"), parse_roman(g["token"]).alias("roman"), parse_word(g["token"]).alias("words"))
        return _let(values, lambda v: F.when(F.coalesce(v["arabic"], v["roman"], v["words"]).isNotNull(), F.struct(
            _kind(g["word"]).alias("kind"), g["word"].alias("word"), F.coalesce(v["arabic"], v["roman"], v["words"]).alias("ordinal"), g["token"].alias("display"),
            F.when(v["arabic"].isNotNull(), "arabic").when(v["roman"].isNotNull(), "roman").otherwise("words").alias("style"), g["title"].alias("title"), none.alias("subtype"), F.lit(fused).alias("fused"),
        ).cast(FIELDS)))

    return _let(F.struct(word.alias("word"), F.regexp_replace(token, f"[{ENDS}]+$", "").alias("token"), title.alias("title")), with_token)


def match_landmark(text: Column) -> Column:
    """A struct (FIELDS), or null: numbered first, then a word fused with its ordinal, then unnumbered."""
    none = F.lit(None).cast("string")

    def of(t: Column) -> Column:
        bare = F.struct(F.lit("unnumbered").alias("kind"), _group(t, BARE, 1).alias("word"), F.lit(None).cast("int").alias("ordinal"), none.alias("display"), none.alias("style"), F.trim(_group(t, BARE, 2)).alias("title"), F.lower(_group(t, BARE, 1)).alias("subtype"), F.lit(False).alias("fused"))
        numbered = F.when(t.rlike(f"(?iu){NUMBERED}"), _counted(_group(t, NUMBERED, 1), _group(t, NUMBERED, 2), F.trim(_group(t, NUMBERED, 4)), False))
        fused = F.when(t.rlike(f"(?iu){FUSED}"), _counted(_group(t, FUSED, 1), _group(t, FUSED, 2), none, True))
        return F.when(t.rlike(f"(?iu)^(?:{_words}|{'|'.join(UNNUMBERED)})"), F.coalesce(numbered, fused, F.when(t.rlike(f"(?iu){BARE}"), bare.cast(FIELDS))))

    return _let(normalize_ws(text), of)


def match_landmark_lines(text: Column) -> Column:
    """A struct of match (FIELDS), ambiguous, lines and captions: the whole text first, else exactly one line that matches."""
    none = F.array().cast("array<string>")

    def by_line(parts: Column) -> Column:
        hits = F.filter(parts, lambda x: x["match"].isNotNull())
        rest = F.transform(F.filter(parts, lambda x: x["match"].isNull()), lambda x: x["line"])
        return _let(hits, lambda h: F.struct(F.when(F.size(h) == 1, F.get(h, F.lit(0))["match"]).alias("match"), (F.size(h) > 1).alias("ambiguous"), F.size(h).alias("lines"), F.when(F.size(h) == 1, rest).otherwise(none).alias("captions")))

    lines = F.filter(F.transform(F.split(text, LINE_ENDS), normalize_ws), lambda x: x != "")
    parts = F.transform(lines, lambda x: F.struct(x.alias("line"), match_landmark(x).alias("match")))
    return _let(match_landmark(text), lambda whole: F.when(whole.isNotNull(), F.struct(whole.alias("match"), F.lit(False).alias("ambiguous"), F.lit(0).alias("lines"), none.alias("captions"))).otherwise(_let(parts, by_line)))
