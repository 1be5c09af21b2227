"""Rules over ordered blocks (doc_id, pos, type, heading_level, text, tags): strip, normalise, classify, validate.

Every rule is one pass partitioned by document and ordered by position, so a chain of rules shares one shuffle and sort.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.landmarks import match_landmark, match_landmark_lines
from quire.functions.text import collapse_spaces, curly_quotes, normalize_ws, strip, without_zero_width, word_count

#: Licence boilerplate, residue of revisions, and the role of a type that no rule has classified.
LICENCE = r"(?i)^(?:the project gutenberg ebook|\*\*\* ?start of (?:the |this )?project gutenberg ebook|\*\*\* ?end of (?:the |this )?project gutenberg ebook|section [0-9]+\. (?:information|general|title)|this ebook is for the use of|updated editions will replace)"
REVISION_MARKS = ("<w:ins", "<w:del", "</w:ins>", "</w:del>", "\u2040", "\u2041", "\u2380")
ROLES = {"paragraph": "body_paragraph", "heading": "heading", "list_item": "list_item", "table": "table", "image": "image", "code": "code_block", "preformatted_block": "code_block", "footnote": "footnote", "blockquote": "blockquote", "page_break": "structural", "horizontal_rule": "structural"}
CARRIERS = ("paragraph", "heading", "blockquote", "list_item", "footnote")
SHORT = 120


def ordered():
    return Window.partitionBy("doc_id").orderBy("pos")


def so_far():
    return ordered().rowsBetween(Window.unboundedPreceding, 0)


def has_tag(name: str) -> Column:
    return F.array_contains(F.coalesce("tags", F.array().cast("array<string>")), name)


def is_empty_line() -> Column:
    return (F.col("type") == "paragraph") & has_tag("empty_line")


def dense(blocks: DataFrame) -> DataFrame:
    """Positions without gaps, after rows were removed."""
    return blocks.withColumn("pos", (F.row_number().over(ordered()) - 1).cast("long"))


def _changed(blocks: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """blocks with the texts, and those of their spans, changed; verbatim blocks and types that carry no text stay as they are."""
    verbatim = F.coalesce("preformatted", F.lit(False)) if "preformatted" in blocks.columns else F.lit(False)
    open_to_change = F.col("type").isin(*CARRIERS) & ~verbatim
    columns = {"text": F.when(open_to_change, change(F.col("text"))).otherwise(F.col("text"))}
    if "spans" in blocks.columns:
        columns["spans"] = F.when(open_to_change, F.transform("spans", lambda span: span.withField("text", change(span["text"])))).otherwise(F.col("spans"))
    return blocks.withColumns(columns)


def collapse_space_runs(blocks: DataFrame) -> DataFrame:
    return _changed(blocks, collapse_spaces)


def drop_empty_runs(blocks: DataFrame) -> DataFrame:
    """Of consecutive empty lines the first stays."""
    again = is_empty_line() & F.coalesce(F.lag(is_empty_line()).over(ordered()), F.lit(False))
    return dense(blocks.withColumn("_again", again).where("not _again").drop("_again"))


def drop_zero_width(blocks: DataFrame) -> DataFrame:
    return _changed(blocks, without_zero_width)


def drop_licence(blocks: DataFrame) -> DataFrame:
    """A licence heading opens a range that the next heading of level 1 or 2 that is none closes; other licence blocks go alone."""
    licence = strip(F.col("text")).rlike(LICENCE)
    event = F.when(licence & (F.col("type") == "heading"), "open").when((F.col("type") == "heading") & F.col("heading_level").isin(1, 2) & ~licence, "close")
    gone = licence | (F.coalesce(F.last(event, ignorenulls=True).over(so_far()), F.lit("close")) == "open")
    return dense(blocks.withColumn("_gone", gone).where("not _gone").drop("_gone"))


def curl_quotes(blocks: DataFrame) -> DataFrame:
    return _changed(blocks, curly_quotes)


def has_visual(blocks: DataFrame, name: str) -> Column:
    """Whether a property holds for the whole block: by a tag, or by a mark on every span that is not blank."""
    if "spans" not in blocks.columns:
        return has_tag(name)
    texts = F.filter("spans", lambda span: normalize_ws(span["text"]) != "")
    return has_tag(name) | F.coalesce((F.size(texts) > 0) & F.forall(texts, lambda span: F.array_contains(span["marks"], name)), F.lit(False))


def visually_gated(blocks: DataFrame) -> Column:
    """A short paragraph that is centred and either bold or large."""
    emphatic = has_visual(blocks, "bold") | has_visual(blocks, "large_font")
    return (F.col("type") == "paragraph") & has_visual(blocks, "centered") & emphatic & (F.length(normalize_ws(F.col("text"))) <= SHORT)


def with_strata(blocks: DataFrame) -> DataFrame:
    """blocks with stratum (null: cannot carry a landmark) and scan, the landmark found in it."""
    stratum = F.when(F.col("type") == "heading", F.concat(F.lit("heading:"), F.coalesce("heading_level", F.lit(0)))).when(visually_gated(blocks), "paragraph_visual")
    if "role" in blocks.columns:
        stratum = F.when(F.col("role").isNull(), stratum)
    rows = blocks.withColumn("stratum", stratum)
    return rows.withColumn("scan", F.when(F.col("stratum").isNotNull(), match_landmark_lines(F.col("text"))))


def strata_counts(rows: DataFrame) -> DataFrame:
    """doc_id, stratum, n, first_pos: chapter landmarks by stratum."""
    return rows.where("scan.match.kind = 'chapter'").groupBy("doc_id", "stratum").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))


def dominant_stratum(counts: DataFrame) -> DataFrame:
    """The stratum with most chapters, of equal ones the one that starts first."""
    return counts.groupBy("doc_id").agg(F.min_by("stratum", F.struct(-F.col("n"), F.col("first_pos"))).alias("dominant"))


def classify_landmarks(rows: DataFrame) -> DataFrame:
    """role, number, title, subtype and dominant: parts in any stratum, chapters in the dominant one, unnumbered ones there or if gated.

    A role that a row has stays, with its subtype. The dominant stratum is a window over the document, which the rows are partitioned by already.
    """
    votes = F.when(F.col("scan.match.kind") == "chapter", 1)
    whole = Window.partitionBy("doc_id", "stratum")
    rows = rows.withColumn("_n", F.count(votes).over(whole)).withColumn("_first", F.min(F.when(votes.isNotNull(), F.col("pos"))).over(whole))
    best = F.min_by("stratum", F.when(F.col("_n") > 0, F.struct(-F.col("_n"), F.col("_first"), F.col("stratum")))).over(Window.partitionBy("doc_id"))
    rows = rows.withColumn("dominant", best).withColumn("_in", F.coalesce(F.col("stratum") == F.col("dominant"), F.lit(False)))
    match = F.col("scan.match")
    kind = match["kind"]
    role = F.when(kind == "part", "part_divider").when((kind == "chapter") & F.col("_in"), "chapter_heading").when((kind == "unnumbered") & (F.col("_in") | visually_gated(rows)), "chapter_heading")
    label = F.when(kind == "unnumbered", F.coalesce(match["title"], normalize_ws(F.col("text")))).otherwise(F.coalesce(match["title"], F.concat_ws(" ", F.initcap(match["word"]), match["display"])))
    title = F.when(kind == "chapter", F.array_join(F.concat(F.array(label), F.col("scan.captions")), "\n")).otherwise(label)
    earlier = {name: F.col(name) if name in rows.columns else F.lit(None).cast("string") for name in ("role", "subtype")}
    rows = rows.withColumns({"_role": role, "role": F.coalesce(earlier["role"], role), "subtype": earlier["subtype"]})
    held = F.col("_role").isNotNull()
    return rows.withColumns({"number": F.when(held, match["ordinal"]), "title": F.when(held, title), "subtype": F.when(held, match["subtype"]).otherwise(F.col("subtype")), "section_word": F.when(held, F.rtrim(F.lower(match["word"]), F.lit(".")))}).drop("_n", "_first", "_in", "_role")


def landmark_warnings(rows: DataFrame) -> DataFrame:
    """doc_id, pos, warning, severity, heading, lines of classified landmarks: blocks of the dominant stratum with several matching lines, and fused headings."""
    ambiguous = F.coalesce(F.col("scan.ambiguous") & (F.col("stratum") == F.col("dominant")), F.lit(False))
    fused = F.coalesce(F.col("scan.match.fused"), F.lit(False)) & F.col("section_word").isNotNull()
    found = rows.withColumn("warning", F.when(ambiguous, "ambiguous").when(fused, "fused")).where("warning is not null")
    heading = F.when(F.col("warning") == "fused", F.concat("scan.match.word", "scan.match.display"))
    return found.select("doc_id", "pos", "warning", F.when(F.col("warning") == "ambiguous", "medium").otherwise("low").alias("severity"), heading.alias("heading"), F.when(F.col("warning") == "ambiguous", F.col("scan.lines").cast("long")).alias("lines"))


def default_roles(rows: DataFrame) -> DataFrame:
    default = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return rows.withColumn("role", F.coalesce("role", F.try_element_at(default, F.col("type"))))


def chapter_continuity(rows: DataFrame) -> DataFrame:
    """doc_id, part_index, section_word, defect_pos, previous, number, defect: the first break of numbering in each scope.

    A scope is a part (before the first one there is part 0) and a section word; unnumbered chapters do not count.
    """
    rows = rows.withColumn("part_index", F.sum((F.col("role") == "part_divider").cast("int")).over(so_far()))
    chapters = rows.where("role = 'chapter_heading' and number is not null and subtype is null")
    scope = Window.partitionBy("doc_id", "part_index", "section_word").orderBy("pos")
    chapters = chapters.withColumn("previous", F.lag("number").over(scope)).where("previous is not null and number <> previous + 1")
    first = chapters.groupBy("doc_id", "part_index", "section_word").agg(F.min_by(F.struct("pos", "previous", "number"), "pos").alias("d"))
    return first.select("doc_id", F.col("part_index").cast("long").alias("part_index"), "section_word", F.col("d.pos").alias("defect_pos"), F.col("d.previous").cast("long").alias("previous"), F.col("d.number").cast("long").alias("number"), F.when(F.col("d.number") > F.col("d.previous") + 1, "gap").otherwise("out of order").alias("defect"))


def signature_deviants(rows: DataFrame) -> DataFrame:
    """doc_id, pos, signature: chapter headings whose (type, level) is not the document's most frequent, of equal ones the first seen."""
    signature = F.when(F.col("type") == "heading", F.concat(F.lit("Heading"), F.col("heading_level"))).otherwise(F.col("type"))
    chapters = rows.where("role = 'chapter_heading'").withColumn("signature", signature)
    same = Window.partitionBy("doc_id", "signature")
    chapters = chapters.withColumn("n", F.count("*").over(same)).withColumn("first", F.min("pos").over(same))
    main = F.min_by("signature", F.struct(-F.col("n"), F.col("first"))).over(Window.partitionBy("doc_id"))
    return chapters.withColumn("main", main).where("signature <> main").select("doc_id", "pos", "signature")


def zero_structure(rows: DataFrame, most_blocks: int = 50, most_words: int = 5000) -> DataFrame:
    """doc_id, block_count, word_count, fires: whether a document of more blocks and more words than these has neither chapter nor part."""
    landmark = F.coalesce(F.col("role").isin("chapter_heading", "part_divider"), F.lit(False))
    found = rows.groupBy("doc_id").agg(F.count("*").alias("block_count"), F.sum(F.coalesce(word_count(F.col("text")), F.lit(0))).alias("word_count"), F.count_if(landmark).alias("landmarks"))
    fires = (F.col("landmarks") == 0) & (F.col("block_count") > most_blocks) & (F.col("word_count") > most_words)
    return found.select("doc_id", "block_count", "word_count", fires.alias("fires"))


def revision_residue(blocks: DataFrame) -> DataFrame:
    """doc_id, pos, residue: each mark of unresolved revisions that a block's text holds."""
    found = F.array_compact(F.array(*(F.when(F.contains(F.col("text"), F.lit(m)), F.lit(m)) for m in REVISION_MARKS)))
    return blocks.select("doc_id", "pos", F.explode(found).alias("residue"))


def landmark_fields(blocks: DataFrame) -> DataFrame:
    return blocks.select("doc_id", "pos", match_landmark(F.col("text")).alias("m")).where("m is not null").select("doc_id", "pos", "m.kind", F.lower("m.word").alias("word"), F.col("m.ordinal").cast("long").alias("ordinal"), "m.display", "m.style", "m.title", "m.subtype", "m.fused")
