"""Structure rules over ordered blocks: source contents, pattern-only landmarks, repeated titles, subtitles, front and back matter, title pages.

Rows are blocks (doc_id, pos, type, heading_level, text, tags) with role and subtype; no rule overwrites a role. All windows are partitioned by
document, so that a chain of rules keeps one shuffle. A null text counts as empty, a null tag list as no tags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.landmarks import CHAPTER_WORDS, PART_WORDS, match_landmark, match_landmark_lines
from quire.functions.ordinals import parse_ordinal
from quire.functions.text import normalize_ws, strip, word_count
from quire.operators import blocks as rules
from quire.operators.blocks import SHORT, has_tag, has_visual, is_empty_line, ordered, so_far

#: Labels, shapes and bounds.
LANDMARKS = ("chapter_heading", "part_divider")
FRONT = r"^(a\s+)?(note|preface|foreword|introduction|dedication|epigraph|prologue|to\s+the\s+reader)"
BACK = r"^(a\s+)?(closing|afterword|epilogue|acknowledgments?|about\s+the\s+author|appendix|resources|notes|bibliography|references|glossary|index)"
CONTENTS = r"^(table\s+of\s+)?contents[.:]?$"
COPYRIGHT = r"(©|\bcopyright\b|all rights reserved)"
DEDICATION = r"^(for|to)\b"
ATTRIBUTION = r"^[—–-]{1,2}\s*\S"
QUOTED = "^[\"“‘«']|[\"”’»]$"
BYLINE = r"^by\s+\S+"
NAME = r"^(?:[A-Z][\p{L}\p{N}_.'’-]*\s+){0,3}[A-Z][\p{L}\p{N}_.'’-]*$"
ALNUM = r"[\p{L}\p{N}]"
LONG, EARLY_TOC, ENTRY, ENTRIES, RESIDUE, APART, TITLE_ROWS, EARLY, GAP = 200, 80, 80, 3, 0.2, 50, 40, 8, 3
CLASSES = {"half_title": "half_title", "copyright": "copyright_page", "copyright_page": "copyright_page", "dedication": "dedication", "epigraph": "epigraph", "foreword": "foreword", "preface": "preface", "introduction": "introduction", "prologue": "prologue", "note_to_reader": "note_to_reader", "generic": "unknown_front"}
GENERATED = ("title_page", "copyright_page", "dedication", "acknowledgements", "about_the_author", "toc_authorial")
INLINE = r"\b(" + "|".join(w.replace(".", r"\.") for w in sorted(CHAPTER_WORDS + PART_WORDS, key=lambda w: (-len(w), w))) + r")\s+([A-Za-z0-9\-]+)"


def prepared(blocks: DataFrame) -> DataFrame:
    """blocks with role and subtype (null where they are not given) and norm, the normalised text."""
    for name in ("role", "subtype"):
        if name not in blocks.columns:
            blocks = blocks.withColumn(name, F.lit(None).cast("string"))
    return blocks.withColumns({"role": F.nullif("role", F.lit("")), "norm": normalize_ws(F.coalesce("text", F.lit("")))})


def _document() -> Window:
    return Window.partitionBy("doc_id")


def _free() -> Column:
    return F.col("role").isNull() & F.col("type").isin("paragraph", "heading")


def _content() -> Column:
    return F.col("norm") != ""


def _among(condition: Column) -> Window:
    """A window over those rows of a document that meet the condition (others form one of their own)."""
    return Window.partitionBy("doc_id", condition).orderBy("pos")


def _alnum() -> Column:
    return F.col("norm").rlike(ALNUM)


def _landmark() -> Column:
    return F.coalesce(F.col("role").isin(*LANDMARKS), F.lit(False))


def _first(condition: Column) -> Column:
    """The first position in the document that meets the condition."""
    return F.min(F.when(condition, F.col("pos"))).over(_document())


def _assign(rows: DataFrame, condition: Column, role: str, subtype: Column | None = None) -> DataFrame:
    held = F.coalesce(condition, F.lit(False))
    rows = rows.withColumn("_now", held)
    return rows.withColumns({"subtype": F.when(F.col("_now"), subtype if subtype is not None else F.lit(None).cast("string")).otherwise(F.col("subtype")), "role": F.when(F.col("_now"), role).otherwise(F.col("role"))}).drop("_now")


# Source contents


def inline_entries(norm: Column) -> Column:
    """array<struct<word, ordinal>> of a text that is little but landmark labels, three at least; else null."""
    pairs = F.arrays_zip(F.regexp_extract_all(norm, F.lit(f"(?iu){INLINE}"), F.lit(1)).alias("word"), F.regexp_extract_all(norm, F.lit(f"(?iu){INLINE}"), F.lit(2)).alias("token"))
    parsed = F.transform(pairs, lambda p: F.struct(F.lower(p["word"]).alias("word"), parse_ordinal(p["token"]).alias("ordinal")))
    found = F.filter(parsed, lambda p: p["ordinal"].isNotNull())
    alnum = lambda x: F.length(F.regexp_replace(x, r"[^\p{L}\p{N}]", ""))
    rest = alnum(F.regexp_replace(norm, f"(?iu){INLINE}", ""))
    return F.get(F.filter(F.array(found), lambda e: (F.size(e) >= ENTRIES) & (rest <= RESIDUE * alnum(norm))), F.lit(0))


def source_contents(blocks: DataFrame) -> DataFrame:
    """Marks the source's own table of contents as structural; entries holds what each of its rows lists.

    Either one block that lists three or more labels, or a run of three or more paragraphs that are bare labels, their ordinals not
    decreasing while the word stays; blank rows are passed over. A "Contents" label right above joins. Only the first 80 blocks count.
    """
    rows = prepared(blocks).withColumn("_early", F.col("pos") < EARLY_TOC)
    inline = F.when(F.col("_early") & _free() & _content(), inline_entries(F.col("norm")))
    rows = rows.withColumn("_inline", inline)
    bare = F.col("_early") & F.col("role").isNull() & (F.col("type") == "paragraph") & (F.length("norm") <= ENTRY) & F.col("_inline").isNull()
    rows = rows.withColumn("_mark", F.when(bare, match_landmark(F.col("norm"))))
    mark = F.col("_mark")
    rows = rows.withColumns({"_seen": _content() & ~has_tag("empty_line"), "_bare": F.coalesce(mark["kind"].isin("chapter", "part") & mark["title"].isNull() & mark["ordinal"].isNotNull(), F.lit(False))})
    rows = rows.withColumn("_bare", F.col("_bare") & F.col("_seen"))
    window = _among(F.col("_seen"))
    rows = rows.withColumn("_run", F.sum((~F.col("_bare")).cast("long")).over(window.rowsBetween(Window.unboundedPreceding, 0)))
    word = F.lower(mark["word"])
    rows = rows.withColumn("_word", word)
    sound = ~F.coalesce(F.lag("_bare").over(window), F.lit(False)) | (mark["ordinal"] >= F.lag(mark["ordinal"]).over(window)) | (F.col("_word") != F.lag("_word").over(window))
    rows = rows.withColumn("_sound", F.when(F.col("_bare"), sound))
    run = Window.partitionBy("doc_id", "_seen", "_run")
    listed = F.col("_bare") & (F.count_if("_bare").over(run) >= ENTRIES) & F.coalesce(F.bool_and("_sound").over(run), F.lit(False))
    rows = rows.withColumn("_listed", listed).withColumn("_toc", F.col("_listed") | F.col("_inline").isNotNull())
    label = F.col("_early") & F.col("_seen") & F.col("role").isNull() & F.col("norm").rlike(f"(?i){CONTENTS}") & F.coalesce(F.lead("_toc").over(window), F.lit(False))
    rows = rows.withColumn("_label", label)
    entry = F.array(F.struct(F.col("_word").alias("word"), mark["ordinal"].alias("ordinal")))
    rows = rows.withColumn("entries", F.coalesce("_inline", F.when(F.col("_listed"), entry)))
    rows = _assign(rows, F.col("_toc") | F.col("_label"), "structural", F.lit("source_toc"))
    return rows.drop("_early", "_inline", "_mark", "_seen", "_bare", "_run", "_word", "_sound", "_listed", "_toc", "_label")


def contents_entries(rows: DataFrame) -> DataFrame:
    """doc_id, pos, entry_no, word, ordinal of each entry in the source's contents."""
    return rows.select("doc_id", "pos", F.posexplode("entries").alias("entry_no", "e")).select("doc_id", "pos", F.col("entry_no").cast("long").alias("entry_no"), "e.word", F.col("e.ordinal").cast("long").alias("ordinal"))


# Landmarks without style


def _with_candidates(blocks: DataFrame) -> DataFrame:
    """Rows with _mark and _cluster, the size of a candidate's cluster (null: no candidate)."""
    rows = prepared(blocks)
    bare = F.col("dominant").isNull() if "dominant" in rows.columns else F.lit(True)
    words = word_count(F.coalesce("text", F.lit("")))
    rows = rows.withColumns({"_words": words, "_bare": bare & ~F.bool_or(_landmark()).over(_document())})
    rows = rows.withColumn("_upto", F.sum("_words").over(so_far()))
    rows = rows.withColumn("_mark", F.when(F.col("_bare") & _free() & _content() & (F.length("norm") <= ENTRY), match_landmark(F.col("norm"))))
    rows = rows.withColumn("_is", F.coalesce((F.col("_mark.kind") != "unnumbered") & F.col("_mark.ordinal").isNotNull(), F.lit(False)))
    window = _among(F.col("_is"))
    between = F.col("_upto") - F.col("_words") - F.lag("_upto").over(window)
    rows = rows.withColumn("_apart", F.coalesce((between >= APART).cast("long"), F.lit(1)))
    rows = rows.withColumn("_island", F.sum("_apart").over(window.rowsBetween(Window.unboundedPreceding, 0)))
    size = F.count("*").over(Window.partitionBy("doc_id", "_is", "_island"))
    rows = rows.withColumns({"_cluster": F.when(F.col("_is"), size), "_kind": F.col("_mark.kind"), "_word": F.rtrim(F.lower("_mark.word"), F.lit("."))})
    return rows.drop("_words", "_bare", "_upto", "_is", "_apart", "_island")


def _with_decisions(rows: DataFrame) -> DataFrame:
    """Rows with _decision: contents, excluded, promoted or left; null for rows without a _cluster."""
    rows = rows.withColumn("_alone", F.coalesce(F.col("_cluster") == 1, F.lit(False)))
    ahead = _among(F.col("_alone")).rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn("_part", F.min(F.when(F.col("_kind") == "part", F.col("pos"))).over(ahead))
    word = Window.partitionBy("doc_id", "_alone", "_kind", "_word")
    by = word.orderBy("pos")
    again = F.coalesce(F.col("_mark.ordinal") <= F.lag("_mark.ordinal").over(by), F.lit(False))
    rows = rows.withColumns({"_again": again, "_before": F.lag("_part").over(by)})
    rows = rows.withColumn("_pivot", F.when(F.col("_again") & (F.col("_kind") == "chapter") & (F.col("_before") < F.col("pos")), F.col("_before")))
    rows = rows.withColumn("_whole", F.col("_alone") & (F.count("*").over(word) >= ENTRIES) & F.bool_and(~F.col("_again") | F.col("_pivot").isNotNull()).over(word))
    used = F.collect_set(F.when(F.col("_whole"), F.col("_pivot"))).over(_document())
    rows = rows.withColumn("_used", (F.col("_kind") == "part") & F.array_contains(used, F.col("pos")))
    decision = F.when(F.col("_cluster") >= ENTRIES, "contents").when(F.col("_cluster") > 1, "excluded").when(F.col("_whole") | F.col("_used"), "promoted").when(F.col("_alone"), "left")
    return rows.withColumn("_decision", decision).drop("_alone", "_part", "_again", "_before", "_pivot", "_whole", "_used")


def pattern_candidates(blocks: DataFrame) -> DataFrame:
    """doc_id, pos, kind, word, number, cluster (its size) of whole-text labels in documents without landmarks.

    Candidates fewer than 50 words apart form a cluster. A column dominant, where there is one, has to be null.
    """
    found = _with_candidates(blocks).where("_cluster is not null")
    return found.select("doc_id", "pos", F.col("_kind").alias("kind"), F.col("_word").alias("word"), F.col("_mark.ordinal").cast("long").alias("number"), F.col("_cluster").alias("cluster"))


def pattern_landmarks(blocks: DataFrame) -> DataFrame:
    """doc_id, pos, kind, word, number, decision (contents, excluded, promoted or left) of candidates.

    A word's sequence is coherent if its numbers rise; a chapter word's may start again after a part that lies between, which is then
    its pivot. Coherent words of three or more labels are promoted, and parts that are pivots of those.
    """
    found = _with_decisions(_with_candidates(blocks)).where("_decision is not null")
    return found.select("doc_id", "pos", F.col("_kind").alias("kind"), F.col("_word").alias("word"), F.col("_mark.ordinal").cast("long").alias("number"), F.col("_decision").alias("decision"))


def promote_patterns(blocks: DataFrame) -> DataFrame:
    """Gives roles to pattern-only landmarks; pattern_word names the word class of each promoted one."""
    rows = _with_decisions(_with_candidates(blocks))
    promoted, mark = F.coalesce(F.col("_decision") == "promoted", F.lit(False)), F.col("_mark")
    contents = F.coalesce(F.col("_decision") == "contents", F.lit(False))
    role = F.when(promoted, F.when(F.col("_kind") == "part", "part_divider").otherwise("chapter_heading")).when(contents, "structural")
    columns = {"role": F.coalesce("role", role), "subtype": F.when(contents, "source_toc").otherwise(F.col("subtype")), "pattern_word": F.when(promoted, F.col("_word"))}
    if "number" in rows.columns:
        title = F.coalesce(mark["title"], F.concat_ws(" ", F.initcap(mark["word"]), mark["display"]))
        columns |= {"number": F.when(promoted, mark["ordinal"]).otherwise(F.col("number")), "title": F.when(promoted, title).otherwise(F.col("title")), "section_word": F.when(promoted, F.col("_word")).otherwise(F.col("section_word"))}
    return rows.withColumns(columns).drop("_mark", "_cluster", "_kind", "_word", "_decision")


def pattern_warnings(rows: DataFrame) -> DataFrame:
    """doc_id, landmarks, classes: documents with landmarks that no style confirms."""
    return rows.where("pattern_word is not null").groupBy("doc_id").agg(F.count("*").alias("landmarks"), F.array_join(F.array_sort(F.collect_set("pattern_word")), ",").alias("classes"))


# Parts, subtitles, front and back matter


def repeated_titles(rows: DataFrame) -> DataFrame:
    """Headings above the dominant level (column dominant) whose text repeats become parts, if some are confirmed only those.

    A part label within the next three blocks that hold text confirms, and gives part_number; a role or another landmark ends the search.
    """
    rows = prepared(rows)
    level = F.regexp_extract("dominant", "^heading:([0-9]+)$", 1).try_cast("int")
    rows = rows.withColumn("_candidate", F.coalesce(F.col("role").isNull() & (F.col("type") == "heading") & (F.coalesce("heading_level", F.lit(0)) < level), F.lit(False)))
    repeated = F.col("_candidate") & _content() & (F.count("*").over(Window.partitionBy("doc_id", "_candidate", "norm")) >= 2)
    rows = rows.withColumn("_repeated", repeated).withColumn("_filled", _content())
    window = _among(F.col("_filled"))
    mark = F.when(F.col("_filled") & F.col("role").isNull(), match_landmark_lines(F.col("text"))["match"])
    rows = rows.withColumn("_m", mark).withColumn("_seen", F.struct(F.when(F.col("role").isNotNull(), "stop").when(F.col("_m").isNull(), "pass").when(F.col("_m.kind") == "part", "part").otherwise("stop").alias("what"), F.col("_m.ordinal").alias("number")))
    for k in (1, 2, 3):
        rows = rows.withColumn(f"_next{k}", F.lead("_seen", k).over(window))
    ahead = F.filter(F.array("_next1", "_next2", "_next3"), lambda x: x["what"] != "pass")
    hit = F.get(ahead, F.lit(0))
    rows = rows.withColumn("_hit", F.when(F.col("_repeated") & (hit["what"] == "part"), hit))
    any_hit = F.bool_or(F.col("_hit").isNotNull()).over(_document())
    rows = rows.withColumn("_part", F.col("_repeated") & (F.col("_hit").isNotNull() | ~any_hit))
    rows = rows.withColumns({"part_number": F.when(F.col("_part"), F.col("_hit.number"))})
    rows = _assign(rows, F.col("_part"), "part_divider", F.col("subtype"))
    return rows.drop("_candidate", "_repeated", "_filled", "_m", "_seen", "_next1", "_next2", "_next3", "_hit", "_part")


def subtitles(rows: DataFrame) -> DataFrame:
    """The block below a landmark, blank ones passed over, if short and italic, centred or a heading of a lower level; gate tells which."""
    rows = prepared(rows).withColumn("_filled", _content() & ~is_empty_line())
    above = F.lag(F.struct("role", "type", "heading_level")).over(_among(F.col("_filled")))
    rows = rows.withColumn("_above", above)
    lower = (F.col("type") == "heading") & (F.col("_above.type") == "heading") & (F.coalesce("heading_level", F.lit(0)) > F.coalesce("_above.heading_level", F.lit(0)))
    gate = F.when(has_visual(rows, "italic"), "italic").when(has_visual(rows, "centered"), "centered").when(lower, "level")
    near = F.col("_filled") & F.coalesce(F.col("_above.role").isin(*LANDMARKS), F.lit(False)) & _free() & (F.length("norm") <= SHORT) & _alnum()
    rows = rows.withColumn("gate", F.when(near, gate))
    return _assign(rows, F.col("gate").isNotNull(), "chapter_subtitle", F.col("subtype")).drop("_filled", "_above")


def _top() -> Column:
    return F.col("role").isNull() & (F.col("type") == "heading") & (F.col("heading_level") == 1)


def front_subtype(text: Column) -> Column:
    """The canonical label that a heading begins with, else generic."""
    raw = F.lower(strip(F.regexp_extract(text, f"(?iu){FRONT}", 2)))
    return F.when(raw.startswith("note") | raw.startswith("to the reader"), "note_to_reader").when(raw != "", raw).otherwise("generic")


def back_subtype(text: Column) -> Column:
    raw = F.lower(strip(F.regexp_extract(text, f"(?iu){BACK}", 2)))
    return F.when(raw == "about the author", "about_the_author").when(raw.isin("acknowledgments", "acknowledgment"), "acknowledgments").when(raw != "", raw).otherwise("generic")


def front_matter(rows: DataFrame) -> DataFrame:
    """Headings of level 1 before the first landmark; one with no known label that begins the document is left for the title page."""
    rows = prepared(rows)
    rows = rows.withColumns({"_cut": _first(_landmark()), "_head": _first(_content()), "_sub": front_subtype(strip(F.coalesce("text", F.lit(""))))})
    here = _top() & (F.col("pos") < F.col("_cut")) & ~((F.col("_sub") == "generic") & (F.col("pos") == F.coalesce("_head", F.lit(-1))))
    return _assign(rows, here, "front_matter", F.col("_sub")).drop("_cut", "_head", "_sub")


def back_matter(rows: DataFrame) -> DataFrame:
    """Headings of level 1 after the last chapter."""
    rows = prepared(rows)
    last = F.max(F.when(F.col("role") == "chapter_heading", F.col("pos"))).over(_document())
    rows = rows.withColumns({"_cut": last, "_sub": back_subtype(strip(F.coalesce("text", F.lit(""))))})
    return _assign(rows, _top() & (F.col("pos") > F.col("_cut")), "back_matter", F.col("_sub")).drop("_cut", "_sub")


def front_shapes(rows: DataFrame) -> DataFrame:
    """Copyright pages, half titles, dedications and epigraphs without headings, before the first landmark or long block."""
    rows = prepared(rows).withColumn("_landmark", _landmark())
    long_ = F.length("norm") >= LONG
    rows = rows.withColumn("_rights", _free() & _content() & F.col("norm").rlike(f"(?iU){COPYRIGHT}"))
    rows = rows.withColumns({"_stop": _first(F.col("_landmark") | (long_ & ~F.col("_rights"))), "_region": _first(F.col("_landmark") | long_), "_rank": F.count_if(_content()).over(so_far())})
    inside = _content() & (F.col("_stop").isNull() | (F.col("pos") < F.col("_stop")))
    counted = F.col("_region").isNull() | (F.col("pos") < F.col("_region"))
    same = Window.partitionBy("doc_id", "norm")
    rows = rows.withColumns({"_inside": inside, "_times": F.count_if(counted).over(same)})
    rows = rows.withColumn("_open", F.col("_inside") & ~F.col("_rights") & ~long_ & _free() & _alnum())
    rows = rows.withColumn("_half", F.col("_open") & (F.col("_times") >= 2) & (F.col("pos") == F.min(F.when(F.col("_open"), F.col("pos"))).over(same)))
    after, later = F.lead("norm", 1).over(ordered()), F.lead("norm", 2).over(ordered())
    rows = rows.withColumns({"_after": after, "_later": later})
    follows = F.coalesce(F.nullif("_after", F.lit("")), F.when(F.col("_after") == "", F.col("_later")), F.lit(""))
    attributed = (F.length(follows) < LONG) & follows.rlike(ATTRIBUTION)
    shape = (
        F.when(F.col("_inside") & F.col("_rights"), "copyright").when(F.col("_half"), "half_title")
        .when(F.col("_open") & (F.col("_rank") > 1) & F.col("norm").rlike(f"(?iU){DEDICATION}"), "dedication")
        .when(F.col("_open") & (F.col("norm").rlike(QUOTED) | attributed), "epigraph")
    )
    rows = rows.withColumn("_shape", shape)
    return _assign(rows, F.col("_shape").isNotNull(), "front_matter", F.col("_shape")).drop("_landmark", "_rights", "_stop", "_region", "_rank", "_inside", "_times", "_open", "_half", "_after", "_later", "_shape")


# Title pages


def title_page(rows: DataFrame) -> DataFrame:
    """Gives the title cluster its role; part is what each row of it says (title, subtitle, author), by_tag whether style qualified any.

    The cluster lies within the first 40 blocks and before two long paragraphs in a row or a landmark. Its rows are short and carry two
    of: centred, large, heading of level 1 or 2, among the first eight that hold text. The first that does not ends it, as does a gap of
    more than three blocks; a byline or name directly below joins.
    """
    rows = prepared(rows)
    long_ = (F.col("type") == "paragraph") & F.col("role").isNull() & (F.length("norm") >= LONG)
    rows = rows.withColumn("_long", long_)
    rows = rows.withColumn("_pair", F.col("_long") & F.coalesce(F.lag("_long").over(ordered()), F.lit(False)) & (F.col("pos") < TITLE_ROWS))
    end = F.least(F.coalesce(_first(F.col("_pair")) - 1, F.lit(TITLE_ROWS)), F.lit(TITLE_ROWS), F.coalesce(_first(_landmark() & _content()), F.lit(TITLE_ROWS)))
    rows = rows.withColumns({"_end": end, "_rank": F.count_if(_content()).over(so_far())})
    rows = rows.withColumn("_candidate", (F.col("pos") < F.col("_end")) & _content() & _free() & (F.length("norm") < LONG) & _alnum())
    high = (F.col("type") == "heading") & F.coalesce(F.col("heading_level").between(1, 2), F.lit(False))
    tags = has_tag("centered").cast("int") + has_tag("large_font").cast("int")
    rows = rows.withColumn("_fit", F.col("_candidate") & (tags + high.cast("int") + (F.col("_rank") <= EARLY).cast("int") >= 2))
    rows = rows.withColumns({"_start": _first(F.col("_fit")), "_gap": F.col("pos") - F.lag("pos").over(_among(F.col("_candidate")))})
    rows = rows.withColumn("_break", _first(F.col("_candidate") & (F.col("pos") > F.col("_start")) & (~F.col("_fit") | (F.col("_gap") > GAP))))
    by, name = F.col("norm").rlike(f"(?i){BYLINE}"), F.col("norm").rlike(NAME)
    near = (F.col("pos") == F.col("_break")) & ~F.col("_fit") & (F.col("_gap") == 1) & (by | name)
    rows = rows.withColumn("_near", F.coalesce(F.col("_candidate") & near, F.lit(False)))
    rows = rows.withColumn("_member", F.col("_near") | F.coalesce(F.col("_fit") & (F.col("_break").isNull() | (F.col("pos") < F.col("_break"))), F.lit(False)))
    person = by | (name & parse_ordinal(F.rtrim("norm", F.lit("."))).isNull())
    part = F.when(F.col("pos") == F.col("_start"), "title").when(F.col("_near"), "author").when(has_tag("large_font") | (F.col("type") == "heading"), "subtitle").when(person, "author").otherwise("subtitle")
    rows = rows.withColumn("part", F.when(F.col("_member"), part))
    rows = rows.withColumn("by_tag", F.when(F.col("_member"), F.bool_or(F.col("_member") & ~F.col("_near") & (tags > 0)).over(_document())))
    return _assign(rows, F.col("_member"), "title_page", F.col("subtype")).drop("_long", "_pair", "_end", "_rank", "_candidate", "_fit", "_start", "_gap", "_break", "_near", "_member")


def title_meta(rows: DataFrame) -> DataFrame:
    """doc_id, title, subtitle (its parts joined by a space), author (the first), mechanism of documents with a title page."""
    rows = rows.where("part is not null").withColumn("_text", strip(F.col("text")))
    lines = F.array_sort(F.collect_list(F.when(F.col("part") == "subtitle", F.struct("pos", F.col("_text").alias("text")))))
    return rows.groupBy("doc_id").agg(
        F.min_by("_text", F.when(F.col("part") == "title", F.col("pos"))).alias("title"), F.nullif(F.array_join(F.transform(lines, lambda x: x["text"]), " "), F.lit("")).alias("subtitle"),
        F.min_by("_text", F.when(F.col("part") == "author", F.col("pos"))).alias("author"), F.when(F.bool_or("by_tag"), "tag path").otherwise("position/shape path").alias("mechanism"),
    )


# Sections of front matter


def matter_class() -> Column:
    subtype = F.lower(strip(F.coalesce("subtype", F.lit(""))))
    front = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in CLASSES.items() for x in pair]), subtype), F.lit("unknown_front"))
    back = F.when(subtype.startswith("about"), "about_the_author").when(subtype.startswith("acknowledg"), "acknowledgements")
    return F.when(F.col("role") == "title_page", "title_page").when(F.col("role") == "front_matter", front).when(F.col("role") == "back_matter", back).when((F.col("role") == "structural") & (subtype == "source_toc"), "toc_authorial")


def matter_sections(rows: DataFrame) -> DataFrame:
    """doc_id, element_no, class, first_pos, last_pos, confidence: adjacent blocks of one class form an element."""
    rows = rows.withColumn("class", matter_class()).where("class is not null")
    rows = rows.withColumn("_island", F.col("pos") - F.row_number().over(Window.partitionBy("doc_id", "class").orderBy("pos")))
    found = rows.groupBy("doc_id", "class", "_island").agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))
    number = (F.row_number().over(Window.partitionBy("doc_id").orderBy("first_pos")) - 1).cast("long")
    return found.select("doc_id", number.alias("element_no"), "class", "first_pos", "last_pos", F.when(F.col("class") == "unknown_front", "low").otherwise("high").alias("confidence"))


def carried(rows: DataFrame) -> DataFrame:
    """doc_id, carried: the classes that need not be generated, sorted and joined by commas."""
    rows = rows.withColumn("class", matter_class())
    return rows.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("class").isin(*GENERATED), F.col("class")))), ",").alias("carried"))


def classify(blocks: DataFrame) -> DataFrame:
    """All classifying rules in their order; every row gets a role that its type has a default for."""
    rows = source_contents(blocks)
    rows = rules.classify_landmarks(rules.with_strata(rows))
    for rule in (promote_patterns, repeated_titles, subtitles, front_matter, back_matter, front_shapes, title_page):
        rows = rule(rows)
    return rules.default_roles(rows)
