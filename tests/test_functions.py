import random

import pytest
from pyspark.sql import functions as F

from quire.functions import landmarks, ordinals, text
from quire.operators import blocks

SCHEMA = "doc_id long, pos long, type string, heading_level int, text string, tags array<string>"


def values(spark, column, items):
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(items)], "k long, x string")
    return [r.y for r in frame.select("k", column(F.col("x")).alias("y")).orderBy("k").collect()]


def test_ordinals(spark):
    tokens = ["12", "0", "LXXIV", "iiii", "IX", "one", "TWENTY-ONE", "ninety nine", "once", "", None, "hundred", "²"]
    assert values(spark, ordinals.parse_ordinal, tokens) == [12, None, 74, 4, 9, 1, 21, 99, None, None, None, None, None]
    assert values(spark, ordinals.ordinal_style, ["3", "V", "five", "x y"]) == ["arabic", "roman", "words", None]


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("CHAPTER IV. THE TITLE", ("chapter", 4, "THE TITLE", False)),
        ("STAVE ONE.", ("chapter", 1, None, False)),
        ("BOOK II", ("part", 2, None, False)),
        ("vol. 3", ("part", 3, None, False)),
        ("CHAPTERXXVII.", ("chapter", 27, None, True)),
        ("Prologue", ("unnumbered", None, None, False)),
        ("Epilogue. The end", ("unnumbered", None, "The end", False)),
        ("Chapter Once", None),
        ("Chapterhouse", None),
        ("A chapter 4", None),
        ("", None),
    ],
)
def test_landmarks(spark, line, want):
    (found,) = values(spark, landmarks.match_landmark, [line])
    assert (found and (found.kind, found.ordinal, found.title, found.fused)) == want


def test_landmark_lines(spark):
    one, two, none = values(spark, landmarks.match_landmark_lines, ["A caption\nCHAPTER II.\n\nmore", "By\nChapter 1\nChapter 2", "nothing\nhere"])
    assert (one.match.ordinal, one.captions, one.ambiguous) == (2, ["A caption", "more"], False)
    assert (two.match, two.ambiguous, two.lines) == (None, True, 2)
    assert (none.match, none.ambiguous, none.lines) == (None, False, 0)


def curled(line):
    """Character by character, as a reader would."""
    out = []
    for k, c in enumerate(line):
        opens = k == 0 or line[k - 1] in " \t\n\r([{<—–‘“"
        out.append({'"': "“" if opens else "”", "'": "‘" if opens else "’"}.get(c, c))
    return "".join(out)


def test_quotes_equal_a_reader(spark):
    rng = random.Random(3)
    lines = ["".join(rng.choice("\"' a(—“<x") for _ in range(rng.randint(0, 12))) for _ in range(300)]
    assert values(spark, text.curly_quotes, lines) == [curled(x) for x in lines]


def test_spaces(spark):
    assert values(spark, text.normalize_ws, ["a   b\x1c", " ", None]) == ["a b", "", None]
    assert values(spark, text.without_zero_width, ["a​b﻿", "x  y z"]) == ["ab", "x y z"]


def frame_of(spark, rows):
    return spark.createDataFrame([(1, k, kind, level, line, tags) for k, (kind, level, line, tags) in enumerate(rows)], SCHEMA)


def test_licence_range(spark):
    rows = [("paragraph", None, "Kept", []), ("heading", 2, "The Project Gutenberg eBook of X", []), ("paragraph", None, "gone", []), ("heading", 3, "gone too", []), ("heading", 1, "Section 1. General", []), ("paragraph", None, "gone", []), ("heading", 1, "Back", []), ("paragraph", None, "Updated editions will replace", []), ("paragraph", None, "Kept as well", [])]
    kept = blocks.drop_licence(frame_of(spark, rows)).orderBy("pos").collect()
    assert [(r.pos, r.text) for r in kept] == [(0, "Kept"), (1, "Back"), (2, "Kept as well")]


def test_dominant_stratum_and_continuity(spark):
    rows = [("heading", 2, "Title", []), ("heading", 3, "LETTER I", []), ("heading", 3, "LETTER II", []), ("heading", 3, "Chapter 1", []), ("heading", 3, "Chapter 2", []), ("heading", 3, "Chapter 4", []), ("heading", 1, "Volume II", []), ("heading", 3, "Chapter 1", []), ("heading", 1, "Chapter 9", []), ("paragraph", None, "Chapter 3", ["centered", "bold"])]
    marked = blocks.with_strata(frame_of(spark, rows))
    assert [tuple(r) for r in blocks.dominant_stratum(blocks.strata_counts(marked)).collect()] == [(1, "heading:3")]
    roles = blocks.classify_landmarks(marked)
    found = {r.pos: (r.role, r.number) for r in roles.collect() if r.role}
    assert found[6] == ("part_divider", 2) and 8 not in found and 9 not in found and found[5] == ("chapter_heading", 4)
    (defect,) = blocks.chapter_continuity(roles).collect()
    assert (defect.part_index, defect.section_word, defect.previous, defect.number, defect.defect) == (0, "chapter", 2, 4, "gap")
    assert {r.role for r in blocks.default_roles(roles).collect()} == {"part_divider", "chapter_heading", "heading", "body_paragraph"}


def test_empty_blocks(spark):
    nothing = frame_of(spark, [])
    for rule in (blocks.drop_licence, blocks.drop_empty_runs, blocks.curl_quotes, blocks.with_strata):
        assert rule(nothing).count() == 0
