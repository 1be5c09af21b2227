import pytest
from pyspark.sql import functions as F

from quire.operators import blocks, structure

SCHEMA = "doc_id long, pos long, type string, heading_level int, text string, tags array<string>"
BODY = "word " * 80


def P(text, *tags):  # noqa: N802
    return ("paragraph", None, text, list(tags))


def H(level, text, *tags):  # noqa: N802
    return ("heading", level, text, list(tags))


def frame(spark, rows, doc_id=1):
    return spark.createDataFrame([(doc_id, k, *row) for k, row in enumerate(rows)], SCHEMA)


def plain_book():
    """Letters, then two volumes whose chapters start again, without any style."""
    rows = [P("A tale")]
    for k in range(1, 5):
        rows += [P(f"Letter {k}"), P(BODY), P(BODY)]
    for part in range(2):
        rows += [P(f"Volume {part + 1}"), P(BODY)]
        for k in range(1, 4):
            rows += [P(f"Chapter {k}"), P(BODY), P("as said in Chapter 1, it rained")]
    return rows


BOOKS = {
    "plain": plain_book(),
    "incoherent": [x for k in (1, 5, 3, 9) for x in (P(f"Chapter {k}"), P(BODY))],
    "few": [x for k in (1, 2) for x in (P(f"Chapter {k}"), P(BODY))],
    "late_cluster": [P(BODY)] * 85 + [P(f"Chapter {k}") for k in range(1, 6)],
    "front": [P("My Book", "centered", "large_font"), P("a novel", "centered"), P("By Ann Lee"), P("", "empty_line"), P("For everyone who ever waited", "centered"), P("“All is well”", "centered"), P("— Someone"), H(1, "Chapter 1"), P(BODY)],
    "subtitles": [H(2, "Stave One"), H(4, "Marley's Ghost"), H(2, "Stave Two"), P("", "empty_line"), P("an italic line", "italic"), H(2, "Stave Three"), P("* * *", "centered"), H(2, "Stave Four"), P("plain and short")],
    "headings": [H(1, "Frankenstein"), H(1, "A Note on the text"), H(1, "Chapter 1"), P(BODY), H(1, "Acknowledgments"), H(1, "Whatever")],
    "null": [("paragraph", None, None, None)],
}


@pytest.fixture(scope="module")
def classified(spark):
    names = list(BOOKS)
    rows = spark.createDataFrame([(names.index(name), k, *row) for name, book in BOOKS.items() for k, row in enumerate(book)], SCHEMA)
    return structure.classify(rows).cache()


def of(classified, name):
    return classified.where(F.col("doc_id") == list(BOOKS).index(name))


def roles(classified, name):
    return {r.pos: r for r in of(classified, name).collect()}


def test_plain_book_is_promoted_by_pattern(classified):
    found = roles(classified, "plain")
    assert [found[k].role for k in (1, 4, 7, 10)] == ["chapter_heading"] * 4
    assert sum(r.role == "chapter_heading" for r in found.values()) == 10
    assert [p for p, r in found.items() if r.role == "part_divider"] == [24]  # the one that chapters start again after
    (warned,) = structure.pattern_warnings(classified).collect()
    assert (warned.doc_id, warned.landmarks, warned.classes) == (0, 11, "chapter,letter,volume")


@pytest.mark.parametrize("name", ["incoherent", "few"])
def test_incoherent_or_few_labels_stay(classified, name):
    assert not any(r.role == "chapter_heading" for r in roles(classified, name).values())


def test_late_cluster_is_contents(classified):
    found = roles(classified, "late_cluster")
    assert [(found[k].role, found[k].subtype) for k in range(85, 90)] == [("structural", "source_toc")] * 5


def test_contents_block_label_and_prose(spark):
    found = structure.source_contents(frame(spark, [P("Contents"), P("", "empty_line"), P("Letter 1 Letter 2 Chapter 1 Chapter 2"), P("In chapter 1 and chapter 2 and chapter 3 we saw many things"), P("Chapter 9")]))
    assert [(r.pos, r.subtype) for r in found.orderBy("pos").collect() if r.role] == [(0, "source_toc"), (2, "source_toc")]
    assert structure.contents_entries(found).count() == 4


def test_falling_run_is_no_contents(spark):
    assert structure.source_contents(frame(spark, [P("Chapter 3"), P("Chapter 2"), P("Chapter 1")])).where("role is not null").count() == 0


def test_repeated_titles_need_confirmation_if_any_has_one(spark):
    rows = [H(2, "The Title"), P("IN TWO VOLUMES.\nVOL. I."), H(3, "Chapter 1"), P(BODY), H(2, "The Title"), P("IN TWO VOLUMES.\nVOL. II."), H(3, "Chapter 1"), P(BODY), H(2, "The Title"), H(3, "Chapter 2")]
    found = structure.repeated_titles(blocks.classify_landmarks(blocks.with_strata(frame(spark, rows)))).orderBy("pos").collect()
    assert [(r.pos, r.part_number) for r in found if r.role == "part_divider"] == [(0, 1), (4, 2)]


def test_front_shapes_and_title_page(classified):
    found = roles(classified, "front")
    assert [found[k].part for k in (0, 1, 2)] == ["title", "subtitle", "author"]
    assert [(found[k].role, found[k].subtype) for k in (4, 5)] == [("front_matter", "dedication"), ("front_matter", "epigraph")]
    (meta,) = structure.title_meta(of(classified, "front")).collect()
    assert (meta.title, meta.subtitle, meta.author, meta.mechanism) == ("My Book", "a novel", "By Ann Lee", "tag path")
    sections = structure.matter_sections(of(classified, "front")).orderBy("first_pos").collect()
    assert [(r["class"], r.first_pos, r.last_pos) for r in sections] == [("title_page", 0, 2), ("dedication", 4, 4), ("epigraph", 5, 5)]


def test_subtitles(classified):
    assert [k for k, r in sorted(roles(classified, "subtitles").items()) if r.role == "chapter_subtitle"] == [1, 4]


def test_headings_before_and_after(classified):
    found = roles(classified, "headings")
    assert found[0].role != "front_matter" and found[1].subtype == "note_to_reader"
    assert [(found[k].role, found[k].subtype) for k in (4, 5)] == [("back_matter", "acknowledgments"), ("back_matter", "generic")]


def test_nothing_and_nulls(spark, classified):
    assert roles(classified, "null")[0].role == "body_paragraph"
    empty = frame(spark, [])
    for rule in (structure.source_contents, structure.promote_patterns, structure.front_shapes, structure.title_page):
        assert rule(empty).count() == 0
