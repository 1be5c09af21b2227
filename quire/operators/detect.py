"""Line typing and the quality detectors of plain text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import word_count
from quire.sources.text import in_order

#: Patterns and keywords that type a line, in order of precedence.
SCENE = r"^\s*\*\s*\*\s*\*\s*$|^\s*#\s*$|^\s*~\s*$|^\s*-{3,}\s*$"
CHAPTER = r"(?i)^(?:chapter\s+[0-9]+|ch\.\s+[0-9]+|[0-9]+\.|part\s+[0-9]+)"
UNORDERED = "^\\s*[\u2022\u2023\u25e6\u2043\u2219]\\s+|^\\s*[-*+]\\s+"
ORDERED = r"^\s*[0-9]+[)]\s+|^\s*[a-z][)]\s+"
KEYWORDS = {"dedication": "front_matter_dedication", "copyright": "front_matter_copyright", "title": "front_matter_title", "contents": "toc_marker", "about the author": "back_matter_about_author", "about author": "back_matter_about_author", "also by": "back_matter_also_by"}
#: What the detectors look for.
IMAGES = r"\[(?:image|figure|photo|illustration)\]"
FOOTNOTES = "\\[[0-9]+\\]|\\([0-9]+\\)|[\u2020\u2021\u00a7]"
RISKY = "[\u2000-\u206f\u2100-\u214f\u2190-\u21ff\u2200-\u22ff\u2300-\u23ff\u2500-\u257f\u2580-\u259f\u25a0-\u25ff]"
OCR = r"(?:^|[^\p{L}\p{N}_])[Il1](?:$|[^\p{L}\p{N}_])|\S{20,}|[a-z][A-Z]|[0-9][a-z]"


def typed(lines: DataFrame) -> DataFrame:
    """lines with block_type, keyword, list_type and chapter_number."""
    text, low = F.col("text"), F.lower("text")
    kind, keyword = F.when(text.rlike(SCENE), "scene_break").when(text.rlike(CHAPTER), "chapter_heading").when(text.rlike(f"{UNORDERED}|{ORDERED}"), "list"), None
    for word, block_type in KEYWORDS.items():
        kind = kind.when(low.contains(word), block_type)
        keyword = (F if keyword is None else keyword).when(low.contains(word), word)
    rows = lines.withColumn("block_type", kind.otherwise("paragraph"))
    plain = F.col("block_type").isin("scene_break", "chapter_heading", "list")
    return rows.select(
        "*", F.when(~plain, keyword).alias("keyword"),
        F.when(F.col("block_type") == "list", F.when(text.rlike(UNORDERED), "unordered").otherwise("ordered")).alias("list_type"),
        F.when(F.col("block_type") == "chapter_heading", F.regexp_extract(text, "[0-9]+", 0).try_cast("long")).alias("chapter_number"),
    )


def list_groups(rows: DataFrame) -> DataFrame:
    """list_group: consecutive list lines of a document share a number, from 1."""
    is_list = F.col("block_type") == "list"
    starts = is_list & ~F.coalesce(F.lag(is_list).over(in_order()), F.lit(False))
    number = F.sum(starts.cast("long")).over(in_order().rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("list_group", F.when(is_list, number))


def stats(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc_id").agg(F.count("*").alias("block_count"), F.sum(word_count(F.col("text"))).alias("word_count"), F.count_if(F.col("block_type") == "chapter_heading").alias("chapter_count"))


def source_meta(rows: DataFrame) -> DataFrame:
    front = F.col("block_type").startswith("front_matter") | (F.col("block_type") == "toc_marker")
    return rows.groupBy("doc_id").agg(F.count_if(F.col("block_type") == "chapter_heading").alias("detected_chapters"), F.bool_or(front).alias("has_front_matter"), F.bool_or(F.col("block_type").startswith("back_matter")).alias("has_back_matter"), F.count("*").alias("total_lines"))


def profile(rows: DataFrame) -> DataFrame:
    """One row a document: blocks, words, chapters, the share of short lines and whether there is front matter."""
    short = F.avg((F.length("text") < 50).cast("double"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("block_count"), F.sum(word_count(F.col("text"))).alias("word_count"), F.count_if(F.col("block_type") == "chapter_heading").alias("chapter_count"), F.round(short, 6).alias("short_ratio"), F.bool_or(F.col("block_type").startswith("front_matter") | (F.col("block_type") == "toc_marker")).alias("has_front_matter"))


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def findings(rows: DataFrame) -> DataFrame:
    """One pass over the lines: for each document all that the detectors count."""
    text, paragraph = F.col("text"), F.col("block_type") == "paragraph"
    marks = lambda c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    first = F.min(F.when(text.rlike(RISKY), F.col("ln_pos"))).over(Window.partitionBy("doc_id"))
    rows = rows.withColumn("first_risky", first)
    return rows.groupBy("doc_id").agg(
        F.count("*").alias("blocks"), _count(F.col("block_type") == "chapter_heading").alias("chapters"), _count(paragraph).alias("paragraphs"),
        _count(F.lower(text).rlike(IMAGES)).alias("images"), _count((marks("\t") >= 3) | (marks("|") >= 3)).alias("tables"), _count(text.rlike(FOOTNOTES)).alias("footnotes"),
        _count(paragraph & (F.length(text) < 50)).alias("short"), _count((F.col("ln_pos") == F.col("first_risky")) | (F.col("ln_pos") > F.col("first_risky")) & text.rlike(f"^{RISKY}")).alias("risky"),
        _count(text.rlike(r"^\s|\s$") & (F.trim(text) != "")).alias("centred"), _count(text.rlike(OCR)).alias("ocr"),
    )


#: Code: (severity, count, condition). A null count is one that the detector does not give.
DETECTORS: dict[str, tuple[str, str, str]] = {
    "DETECTED_IMAGES": ("'high'", "images", "images > 0"),
    "DETECTED_TABLES": ("'high'", "tables", "tables > 0"),
    "DETECTED_FOOTNOTES": ("'medium'", "footnotes", "footnotes > 0"),
    "LOW_CHAPTER_CONFIDENCE": ("CASE WHEN chapters = 0 THEN 'medium' ELSE 'low' END", "CAST(NULL AS BIGINT)", "chapters = 0 AND blocks > 50 OR chapters > 0 AND blocks > 500 * chapters"),
    "POEM_LIKE_BLOCKS": ("'medium'", "short", "paragraphs > 0 AND 5 * short > paragraphs"),
    "UNICODE_RISK": ("'low'", "risky", "risky > 0"),
    "HEAVY_CENTERING": ("'low'", "centred", "10 * centred > blocks"),
    "OCR_QUALITY_ISSUES": ("'medium'", "ocr", "ocr > 5"),
}


def warnings(rows: DataFrame, *codes: str) -> DataFrame:
    """doc_id, code, severity, cnt of the detectors that fire."""
    found = findings(rows)
    parts = [F.expr(f"CASE WHEN {when} THEN struct('{code}' AS code, {severity} AS severity, {count} AS cnt) END") for code, (severity, count, when) in DETECTORS.items() if not codes or code in codes]
    return found.select("doc_id", F.explode(F.array_compact(F.array(*parts))).alias("w")).select("doc_id", "w.code", "w.severity", F.col("w.cnt").cast("long").alias("cnt"))


def histogram(rows: DataFrame) -> DataFrame:
    return rows.groupBy("block_type").agg(F.count("*").alias("n"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
